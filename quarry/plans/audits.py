"""Audits of published corpora as joins: each returns rows of findings, none where all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, udfs
from ..operators.matching import edge_changes, multiset_difference, reconciled
from ..operators.ordered import first_of_each

CYRILLIC = r"[Ѐ-ӿ]"


def source_to_corpus(topics: DataFrame, records: DataFrame) -> DataFrame:
    """section, issue: topics without a record and the reverse, other titles, pages outside a topic's, other hashes.

    topics: section, title, first_page, last_page, sha256; records: section, title, first_page, last_page, source_sha256.
    """
    a = topics.select("section", udfs.normalized("title").alias("a_title"), F.col("first_page").alias("a_first"), F.col("last_page").alias("a_last"), F.col("sha256").alias("a_hash"))
    b = records.select("section", udfs.normalized("title").alias("b_title"), F.col("first_page").alias("b_first"), F.col("last_page").alias("b_last"), F.col("source_sha256").alias("b_hash"))
    within = F.col("b_first").between(F.col("a_first"), F.col("a_last")) & F.col("b_last").between(F.col("a_first"), F.col("a_last"))
    return reconciled(a, b, "section", {"title": (F.col("a_title"), F.col("b_title")), "pages": (within, F.lit(True)), "hash": (F.lower("a_hash"), F.lower("b_hash"))})


def repeated_sections(records: DataFrame) -> DataFrame:
    return records.groupBy("section").agg(F.count("*").alias("n")).filter("n > 1")


def printed_and_recorded(printed: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """The key with `printed` and `recorded` titles, for keys that one side alone has."""
    a = printed.groupBy(key).agg(F.array_sort(F.collect_list("title")).alias("printed"))
    b = records.groupBy(key).agg(F.array_sort(F.collect_list("title")).alias("recorded"))
    return a.join(b, key, "full_outer").filter("printed IS NULL OR recorded IS NULL")


def field_labels(events: DataFrame, label: Column) -> DataFrame:
    """text, size, bold, n: how the labels of fields are printed."""
    return events.filter(label.isNotNull()).groupBy("text", F.round("size", 2).alias("size"), "bold").agg(F.count("*").alias("n"))


def field_gaps(printed: DataFrame, commands: DataFrame) -> DataFrame:
    """section, gap: fields that are printed (printed: section, labels) and empty in the record."""
    has = lambda *names: F.arrays_overlap("labels", F.array(*[F.lit(n) for n in names]))
    gap = F.array_compact(
        F.array(
            F.when(has("Examples") & (F.size("examples") == 0), "examples"),
            F.when(has("Format") & (F.size("clis") == 0), "clis"),
            F.when(has("Usage Guidelines") & (F.col("usage_guidelines") == ""), "usage_guidelines"),
            F.when(has("Related Topics", "Related Commands", "Related Information", "See Also") & (F.size("related_topics") == 0), "related_topics"),
        )
    )
    return printed.join(commands, "section").select("section", F.explode(gap).alias("gap"))


def selected_pages(selected: DataFrame, original: DataFrame, first: int) -> DataFrame:
    """page, issue: pages of a selection that aren't those of the original from `first` on, nulls equal to each other.

    Both: page, text, width, height, images.
    """
    b = original.select((F.col("page") - (first - 1)).alias("page"), *[F.col(c).alias(f"__{c}") for c in ("text", "width", "height", "images")])
    d = selected.join(b, "page", "left")
    differs = lambda c: F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), c)
    return d.select("page", F.explode(F.array_compact(F.array(*[differs(c) for c in ("text", "width", "height", "images")]))).alias("issue"))


def broken_targets(commands: DataFrame) -> DataFrame:
    """section, title, issue: topics whose files aren't those of their target sections, or aren't there.  Needs `file`."""
    from ..sources.publish import with_targets

    again = with_targets(commands).select("section", F.col("related_topics").alias("__again"))
    d = commands.join(again, "section").select("section", F.explode(F.arrays_zip("related_topics", "__again")).alias("z"))
    stale = d.filter(~F.col("z.related_topics.target_files").eqNullSafe(F.col("z.__again.target_files"))).select("section", "z.related_topics.title", F.lit("stale_files").alias("issue"))
    named = d.select("section", "z.related_topics.title", F.explode("z.related_topics.target_files").alias("file"))
    return stale.unionByName(named.join(commands.select("file"), "file", "left_anti").select("section", "title", F.lit("no_such_file").alias("issue")).distinct())


def topic_counts(commands: DataFrame) -> DataFrame:
    """reference_kind, topics, resolved, with_files, of all topics."""
    t = commands.select(F.explode("related_topics").alias("t"))
    return t.groupBy(F.col("t.reference_kind").alias("reference_kind")).agg(F.count("*").alias("topics"), F.count_if(F.size("t.target_sections") > 0).alias("resolved"), F.count_if(F.size("t.target_files") > 0).alias("with_files"))


def target_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """section, added, removed targets of each command whose targets changed."""
    flat = lambda d: d.select("section", F.array_distinct(F.flatten(F.transform("related_topics", lambda t: t["target_sections"]))).alias("targets"))
    return edge_changes(flat(before), flat(after), "section", "targets").filter(F.size("added") + F.size("removed") > 0)


def warning_review(commands: DataFrame, samples: int = 3) -> DataFrame:
    """category, occurrences, commands, samples: each kind of warning with the first commands that have it."""
    w = commands.select("section", "ord", F.explode("warnings").alias("warning")).withColumn("category", text.category(F.col("warning")))
    counts = w.groupBy("category").agg(F.count("*").alias("occurrences"), F.count_distinct("section").alias("commands"))
    once = w.groupBy("category", "section").agg(F.min_by("warning", "warning").alias("warning"), F.min("ord").alias("ord"))
    shown = first_of_each(once, ["category"], [F.asc("ord"), F.asc("section")], samples)
    shown = shown.groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "section", "warning"))), lambda x: F.struct(x["section"].alias("section"), x["warning"].alias("warning"))).alias("samples"))
    return counts.join(shown, "category")


def text_loss(source: DataFrame, result: DataFrame, key: str) -> DataFrame:
    """key, word, missing: words that a key's source text has more often than its result."""
    words = lambda d: d.select(key, F.explode(text.census_words(udfs.nfkc("text"))).alias("word"))
    return multiset_difference(words(source), words(result), [key, "word"])


def cyrillic(commands: DataFrame) -> DataFrame:
    """Sections with a Cyrillic letter anywhere."""
    return commands.filter(F.to_json(F.struct(*[c for c in commands.columns if c != "section"])).rlike(CYRILLIC)).select("section")


def parameter_targets(commands: DataFrame, k: int = 30) -> DataFrame:
    """The k commands that most parameters are about: section, n."""
    t = commands.select(F.explode("related_topics").alias("t")).filter("t.reference_kind = 'parameter_topic'")
    return t.select(F.explode("t.target_sections").alias("section")).groupBy("section").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "section").limit(k)


def defaults_evidence(commands: DataFrame, most: int = 4000) -> DataFrame:
    """section, evidence: what the extra text says on defaults, for commands without views."""
    said = F.regexp_extract("extra", r"(?s)(?:^|\n\n)Defaults:\n(.*?)(?:\n\n[A-Z][^\n]*:\n|\z)", 1)
    return commands.filter(F.size("views") == 0).select("section", F.substring(said, 1, most).alias("evidence")).filter("evidence <> ''")
