"""From events to commands: headings, fields, and the report on what was found.

All is keyed by doc_id, so references of many documents are read at once, and no plan holds more of
one command in a task than its own events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import grammar, text
from ..operators import fields as X
from ..operators.ordered import commands as segmented
from ..operators.ordered import paragraph_text, section_numbers
from .profiles import Profile

KEY, ORDER = X.KEY, X.ORDER
PRIMARY = ("Function", "Format", "Parameters", "Views", "Usage Guidelines", "Examples")
NUMBER = r"^(\d+(?:\.\d+)*)\s+(.+)$"
OUTLINE = "doc_id string, idx int, title string, page int, level int"


def outline_entries(bookmarks: DataFrame, profile: Profile) -> DataFrame:
    """doc_id, idx, section, title, page, level of a table of bookmarks (idx, title, page, level)."""
    b = bookmarks.filter("page > 0").withColumn("title", text.unwrap(F.col("title")))
    if profile.numbered:
        b = b.withColumn("section", F.regexp_extract("title", NUMBER, 1)).filter("section <> ''").withColumn("title", F.regexp_extract("title", NUMBER, 2))
        for section, title in profile.excluded:
            b = b.filter(~((F.col("section") == section if section else F.lit(True)) & (F.col("title") == title if title else F.lit(True))))
        return b
    b = section_numbers(b)
    if profile.capital_titles is not None:
        first = F.min(F.when((F.col("level") == 2) & F.col("title").endswith(" Commands"), F.col("page"))).over(Window.partitionBy("doc_id"))
        b = b.withColumn("__first", first).filter("(__first IS NULL OR page >= __first) AND level <= 3 AND title <> 'Information About Tracing'").drop("__first")
    return b


def cropped(events: DataFrame, pages: DataFrame, profile: Profile) -> DataFrame:
    """Events between a page's header and footer.  pages: doc_id, page, height."""
    return events.join(pages.select("doc_id", "page", "height"), ["doc_id", "page"]).filter((F.col("y0") > profile.header) & (F.col("y1") < F.col("height") - profile.footer)).drop("height")


def headed(events: DataFrame, outline: DataFrame, profile: Profile, width: float = 595.0) -> DataFrame:
    """Events with h_section and h_title where a command's heading stands."""
    t = text.strip(F.col("text"))
    bold = (F.col("kind") == "line") & F.col("bold") & (F.col("size") >= profile.heading_size)
    if profile.numbered:
        e = events.withColumn("h_section", F.when(bold & (F.col("x0") < width * profile.heading_left) & t.rlike(NUMBER), F.regexp_extract(t, NUMBER, 1)))
        e = e.withColumn("h_title", F.when(F.col("h_section").isNotNull(), F.regexp_extract(t, NUMBER, 2)))
        if not profile.bookmark_titles:
            return e.withColumn("h_whole", F.lit(False))
        first = outline.groupBy("doc_id", "section", "page").agg(F.min_by("title", "idx").alias("__title"))
        e = e.join(first.withColumnRenamed("section", "h_section"), ["doc_id", "page", "h_section"], "left")
        return e.withColumn("h_title", F.coalesce("__title", "h_title")).withColumn("h_whole", F.col("__title").isNotNull()).drop("__title")
    lines = events.filter(bold).select("doc_id", "page", "ord", t.alias("__t"))
    hits = lines.join(outline.select("doc_id", "page", "idx", "section", "title"), ["doc_id", "page"]).filter(profile.same_title(F.col("title"), F.col("__t")))
    hits = hits.groupBy("doc_id", "page", "ord").agg(F.min_by(F.struct(F.col("section").alias("h_section"), F.col("title").alias("h_title")), "idx").alias("h"))
    return events.join(hits.select("doc_id", "page", "ord", "h.*"), ["doc_id", "page", "ord"], "left").withColumn("h_whole", F.lit(True))


def labelled(events: DataFrame, profile: Profile) -> DataFrame:
    """The events within commands, headings and labels left out, each with its field; null fields are preambles."""
    label = profile.label()
    e = segmented(events.withColumn("__label", label), F.col("h_section").isNotNull(), F.col("__label"))
    e = e.filter("h_section IS NULL AND __label IS NULL").drop("__label", "h_section", "h_title", "h_whole")
    if not profile.unlabelled:
        return e
    # Without labels, a description comes first and the first emphasised line below it begins the syntax.
    w = Window.partitionBy(*KEY).orderBy(*ORDER)
    before = F.col("field").isNull()
    word = F.try_element_at(F.filter("spans", lambda s: s["text"].rlike(r"(?U)\w")), F.lit(1))
    if profile.body_left:
        e = e.filter(~before | (F.col("kind") != "line") | (F.col("size") < profile.heading_size))
        caption = before & (F.col("kind") == "line") & F.col("text").rlike(r"^\p{Lu}") & (F.col("size") >= profile.label_size) & (F.col("x0") >= profile.body_left)
        caption = caption & F.forall(F.filter("spans", lambda s: F.trim(s["text"]) != ""), lambda s: s["flags"].bitwiseAND(X.BOLD) != 0)
        e = e.withColumn("field", F.when(caption, "Format captions").otherwise(F.col("field")))
        before = F.col("field").isNull()
        apart = F.coalesce(F.col("y0") - F.lag("y1").over(w) > X.LEADING, F.lit(True))
        styled = (word["flags"].bitwiseAND(X.BOLD | X.MONO | X.ITALIC) != 0) & (word["size"] >= profile.label_size) & (word["size"] < 14)
        starts = before & (F.col("x0") >= profile.body_left) & styled & apart
    else:
        starts = before & F.col("bold") & (F.col("size") < 14)
    starts = F.coalesce(starts & (F.col("kind") == "line"), F.lit(False))
    e = e.withColumn("__begun", F.max(starts).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    own = Window.partitionBy(*KEY)
    has = lambda f: F.max(F.coalesce(F.col("field") == f, F.lit(False))).over(own)
    e = e.withColumn("__f", has("Function")).withColumn("__s", has("Format"))
    taken = F.when(before & F.col("__begun") & ~F.col("__s"), "Format").when(before & ~F.col("__begun") & ~F.col("__f"), "Function")
    return e.withColumn("field", F.coalesce("field", taken)).drop("__begun", "__f", "__s")


def prose(events: DataFrame, by: list[str]) -> DataFrame:
    """The events of each key as one text; tables as their cells."""
    cells = F.array_join(F.transform("rows", lambda r: F.array_join(F.transform(r, lambda c: text.unwrap(c)), " | ")), "\n")
    lines = events.withColumn("text", F.when(F.col("kind") == "table", cells).otherwise(F.col("text")))
    return paragraph_text(lines, by, ORDER)


@pandas_udf(T.ArrayType(T.StringType()))
def undocumented(clis, names):
    """The placeholders of templates that no parameter's name holds as a word."""
    import re

    import pandas as pd

    def one(templates, known):
        told = " ".join(known)
        found = (m for t in templates for m in re.findall(r"(?<!&)<([^<>]+)>", t))
        return [n for n in found if not re.search(rf"(?<![\w-]){re.escape(n)}(?![\w-])", told)]

    return pd.Series([one(c, n) for c, n in zip(clis, names, strict=True)], dtype=object)


def validated(commands: DataFrame) -> Column:
    """The warnings of commands: those of extraction, what is missing, bad syntax, placeholders without a parameter."""
    empty = lambda c, said: F.when(c, F.array(F.lit(said))).otherwise(F.array().cast("array<string>"))
    bad = F.transform(grammar.syntax_issues(F.col("clis")), lambda x: F.concat(x["code"], F.lit(": "), x["cli"]))
    lost = F.transform(undocumented("clis", F.transform("parameters", lambda p: p["name"])), lambda n: F.concat(F.lit("undocumented_parameter: "), n))
    return F.array_distinct(
        F.concat(
            "warnings",
            empty(F.col("title") == "", "missing_title"),
            empty(F.size("clis") == 0, "missing_format"),
            empty(F.col("function") == "", "missing_function"),
            empty(F.size("views") == 0, "missing_views"),
            bad,
            lost,
        )
    )


def parse(events: DataFrame, outline: DataFrame, profile: Profile, width: float = 595.0) -> DataFrame:
    """The commands of events: section, title, pages, templates, function, views, parameters, examples, guidelines, extra text, related topics, warnings.

    Sections without a function and templates are chapters and give no command.  An empty document gives none.
    """
    e = headed(X.typed(events), outline, profile, width)
    heads = segmented(e, F.col("h_section").isNotNull(), F.lit(None).cast("string"))
    w = Window.partitionBy(*KEY)
    wrapped = (F.col("kind") == "line") & F.col("bold") & (F.col("size") >= profile.heading_size) & F.col("h_section").isNull() & F.lit(profile.numbered)
    labels = heads.withColumn("__labels", F.sum(F.when(profile.label().isNotNull(), 1).otherwise(0)).over(w.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    more = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(wrapped & (F.col("__labels") == 0), F.struct(*ORDER, text.strip(F.col("text")).alias("t"))))), lambda x: x["t"]), " ")
    heads = labels.groupBy(*KEY).agg(F.max("h_section").alias("section"), F.max("h_title").alias("title"), F.max("h_whole").alias("whole"), more.alias("more"), F.min("page").alias("start_page"), F.max("page").alias("end_page"))
    heads = heads.withColumn("title", F.when(~F.col("whole") & (F.col("more") != ""), F.concat_ws(" ", "title", "more")).otherwise(F.col("title"))).drop("whole", "more")
    e = labelled(e, profile)
    named = e.filter("field IS NOT NULL")
    texts = prose(named, [*KEY, "field"])
    wide = texts.groupBy(*KEY).agg(*[F.coalesce(F.max(F.when(F.col("field") == f, F.col("text"))), F.lit("")).alias(a) for f, a in (("Function", "function"), ("Views", "__views"), ("Usage Guidelines", "usage_guidelines"), ("Format", "__format"), ("Parameters", "__parameters"))], F.collect_set("field").alias("__fields"))
    wide = wide.filter(F.arrays_overlap("__fields", F.array(F.lit("Function"), F.lit("Format"))))
    c = heads.join(wide, KEY)
    if profile.capital_titles is not None:
        c = c.filter(~F.col("title").rlike(r"^\p{Lu}") | F.col("title").isin(*profile.capital_titles))
    of = lambda f: named.filter(F.col("field") == f)
    c = c.join(X.formats(of("Format"), conditions=profile.conditions, inverse=profile.inverse, keyword=profile.keyword, split_inverse=profile.split_inverse), KEY, "left")
    c = c.join(X.parameters(of("Parameters"), profile.no_parameters), KEY, "left")
    found = X.examples(of("Examples"), profile.prompt, profile.caption)
    if profile.unlabelled:
        found = found.join(X.listings(of("Examples"), c.select(*KEY, "title", F.coalesce("clis", F.array().cast("array<string>")).alias("clis"))).withColumnRenamed("examples", "__listed"), KEY, "full_outer")
        found = found.withColumn("examples", F.when(F.size("examples") > 0, F.col("examples")).otherwise(F.col("__listed"))).drop("__listed")
    c = c.join(found, KEY, "left")
    other = prose(X.content(named.filter(~F.col("field").isin(*PRIMARY)), [*KEY, "field"]), [*KEY, "field"])
    firsts = named.groupBy(*KEY, "field").agg(F.min(F.struct(*ORDER)).alias("at"))
    other = other.join(firsts, [*KEY, "field"]).groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "field", "text"))), lambda x: F.concat(x["field"], F.lit(":\n"), x["text"])), "\n\n").alias("__other"))
    source = F.when(F.col("kind") == "table", F.array_join(F.transform("rows", lambda r: F.array_join(F.transform(r, lambda x: text.unwrap(x)), " | ")), "\n")).otherwise(text.strip(F.col("text")))
    shown = X.content(of("Examples"), KEY).withColumn("__l", source).groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, "__l"))), lambda x: x["__l"]), "\n").alias("__shown"))
    topic = F.struct("title", "description", "source_section", F.array().cast("array<string>").alias("target_sections"), F.array().cast("array<string>").alias("target_files"), F.lit("").alias("reference_kind"))
    topics = X.related(named).groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("source_section", "pos", topic.alias("topic")))), lambda x: x["topic"]).alias("related_topics"))
    c = c.join(other, KEY, "left").join(shown, KEY, "left").join(topics, KEY, "left")
    none = F.array().cast("array<string>")
    or_none = lambda n, kind: F.coalesce(n, F.array().cast(kind)).alias(n)
    said = F.concat(*[F.coalesce(n, none) for n in ("format_warnings", "parameter_warnings", "example_warnings")])
    told = lambda start: F.exists(F.col("warnings"), lambda x: x.startswith(start))
    c = c.withColumn("warnings", F.array_distinct(said))
    extra = F.concat_ws(
        "\n\n",
        "__other",
        F.when(told("conditional_format"), F.concat(F.lit("Format applicability (source text):\n"), "__format")).when(told("table_in_format"), F.concat(F.lit("Format (source text):\n"), "__format")),
        F.when(told("unparsed_parameter"), F.concat(F.lit("Parameters (source text):\n"), "__parameters")),
        F.concat(F.lit("Examples (source text):\n"), "__shown"),
    )
    c = c.select(
        "doc_id", "section", "title", "start_page", "end_page", or_none("clis", "array<string>"), "function", F.col("__views").alias("__v"),
        or_none("parameters", "array<struct<name:string,info:string>>"), or_none("examples", "array<array<string>>"), "usage_guidelines", extra.alias("extra"),
        or_none("related_topics", X_TOPICS), "warnings", F.col("command_id").alias("ord"),
    )
    edge = r"^[ .•●]+|[ .•●]+$"
    views = F.filter(F.transform(F.split("__v", r"[,;\n]+"), lambda v: F.regexp_replace(v, edge, "")), lambda v: v != "")
    c = c.withColumn("views", views).drop("__v")
    return c.withColumn("warnings", validated(c))


X_TOPICS = "array<struct<title:string,description:string,source_section:string,target_sections:array<string>,target_files:array<string>,reference_kind:string>>"


def summary(commands: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row of counts for each document, with its issues and (expected: doc_id, section) the sections that were not found."""
    full = lambda c: F.count_if(F.col(c) != "")
    issue = F.when(F.size("warnings") > 0, F.struct("ord", "section", "title", F.array("start_page", "end_page").alias("pages"), "warnings"))
    d = commands.groupBy("doc_id").agg(
        F.count("*").alias("commands"),
        F.sum(F.size("clis")).alias("templates"),
        F.sum(F.size("parameters")).alias("parameters"),
        F.sum(F.size("examples")).alias("example_snippets"),
        full("usage_guidelines").alias("commands_with_usage_guidelines"),
        full("extra").alias("commands_with_extra_info"),
        F.count_if(F.size("related_topics") > 0).alias("commands_with_related_topics"),
        F.sum(F.size("related_topics")).alias("related_topics"),
        F.array_sort(F.collect_list(issue)).alias("issues"),
    )
    if expected is None:
        return d
    lost = expected.join(commands.select("doc_id", "section"), ["doc_id", "section"], "left_anti").groupBy("doc_id").agg(F.array_sort(F.collect_set("section")).alias("missing_outline_sections"))
    return d.join(lost, "doc_id", "left").withColumn("missing_outline_sections", F.coalesce("missing_outline_sections", F.array().cast("array<string>")))
