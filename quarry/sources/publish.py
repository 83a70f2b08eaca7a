"""Publication of corpora: a folder of records with manifest and report, one Markdown document, enriched copies.

Tasks write one file for each command below a staging folder beside the output, which must be shared by
all executors; a repeated task writes the same bytes again.  The driver renames the folder when all
is there, and never replaces an existing one.
"""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import grammar, text
from ..functions.udfs import key_of
from ..operators import links
from ..operators.topics import parameter_topics
from ..tables import settled
from . import corpus


@contextmanager
def staged(output: Path) -> Iterator[Path]:
    """A folder that becomes `output` if all goes well, and goes if not."""
    output = Path(output)
    if output.exists():
        raise ValueError(f"{output} exists already")
    output.parent.mkdir(parents=True, exist_ok=True)
    stage = output.parent / f".{output.name}-{uuid.uuid4().hex}"
    stage.mkdir()
    try:
        yield stage
        if output.exists():
            raise ValueError(f"{output} exists already")
        stage.rename(output)
    finally:
        shutil.rmtree(stage, ignore_errors=True)


def topic_lines() -> Column:
    """The related topics of a command as a Markdown list, null without any."""
    listed = lambda c: F.array_join(F.transform(c, text.prose), ", ")
    line = lambda t: F.concat(
        F.lit("- "),
        text.prose(t["title"]),
        F.lit(" — Source section: "),
        text.prose(t["source_section"]),
        F.when(t["reference_kind"] != "documented_reference", F.concat(F.lit(". Reference kind: "), text.prose(t["reference_kind"]))).otherwise(""),
        F.when(t["description"] != "", F.concat(F.lit(". "), F.replace(text.prose(t["description"]), F.lit("\n"), F.lit(" ")))).otherwise(""),
        F.when(F.size(t["target_sections"]) > 0, F.concat(F.lit(". Reference sections: "), listed(t["target_sections"]))).otherwise(". Target not resolved in the reference outline."),
        F.when(F.size(t["target_files"]) > 0, F.concat(F.lit(". JSON files: "), listed(t["target_files"]))).otherwise(""),
    )
    return F.when(F.size("related_topics") > 0, F.concat(F.lit("### Related Topics\n\n"), F.array_join(F.transform("related_topics", line), "\n")))


def command_markdown(anchor: Column | None = None) -> Column:
    """A command with its related topics and warnings; needs `warnings` beside a record's columns."""
    warned = F.when(F.size("warnings") > 0, F.concat(F.lit("### Extraction Warnings\n\n"), F.array_join(F.transform("warnings", lambda w: F.concat(F.lit("- "), text.prose(w))), "\n")))
    body = F.regexp_replace(corpus.markdown(anchor), r"\n\z", "")
    # Topics come before additional information.
    extra = F.lit("\n\n### Additional Information\n\n")
    at = F.when(F.col("extra") != "", F.length(body) - F.length(F.concat(extra, text.code_block(F.col("extra")))))
    with_topics = F.when(at.isNotNull(), F.concat_ws("\n\n", F.substring(body, F.lit(1), at), topic_lines(), F.substring(body, at + 3, F.length(body)))).otherwise(F.concat_ws("\n\n", body, topic_lines()))
    return F.concat(F.concat_ws("\n\n", with_topics, warned), F.lit("\n"))


def with_files(commands: DataFrame) -> DataFrame:
    """Commands with `file`; two with one name are an error."""
    d = commands.withColumn("file", text.filename(F.col("section"), F.col("title"))).withColumn("__n", F.count("*").over(Window.partitionBy("file")))
    return d.withColumn("file", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("Duplicate command section: "), "file")).cast("string")).otherwise(F.col("file"))).drop("__n")


def with_targets(commands: DataFrame) -> DataFrame:
    """Commands whose topics name the files of their targets, in order, each once, their own left out."""
    t = commands.select("section", F.posexplode("related_topics").alias("pos", "t"))
    files = commands.select(F.col("section").alias("dst"), F.col("file").alias("dst_file")).filter("dst <> ''").dropDuplicates(["dst"])
    hits = t.select("section", "pos", F.posexplode(F.array_distinct("t.target_sections")).alias("k", "dst")).join(files, "dst").filter("dst <> section")
    named = hits.groupBy("section", "pos").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("k", "dst_file"))), lambda x: x["dst_file"])).alias("f"))
    done = t.join(named, ["section", "pos"], "left").withColumn("t", F.col("t").withField("target_files", F.coalesce("f", F.array().cast("array<string>"))))
    done = done.groupBy("section").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]).alias("__topics"))
    return commands.join(done, "section", "left").withColumn("related_topics", F.coalesce("__topics", "related_topics")).drop("__topics")


def write_files(rows: DataFrame, folder: Path) -> None:
    """Writes each row's `json` and `md` under its `file`."""
    where = str(folder)

    def put(part) -> None:
        for r in part:
            path = Path(where) / r["file"]
            path.write_text(json.dumps(json.loads(r["json"]), ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
            path.with_suffix(".md").write_text(r["md"], encoding="utf-8")

    rows.select("file", "json", "md").foreachPartition(put)


@pandas_udf(T.StringType())
def merged_record(raw: pd.Series, topics: pd.Series, issues: pd.Series) -> pd.Series:
    """A record's JSON with new topics and syntax issues; what else it holds stays."""
    return pd.Series([json.dumps(json.loads(r) | {"related_topics": json.loads(t), "syntax_issues": json.loads(i)}, ensure_ascii=False) for r, t, i in zip(raw, topics, issues, strict=True)], dtype=object)


def declared_topics(commands: DataFrame, names: links.Names) -> DataFrame:
    """src, ord and the topics that records carry themselves, numbered lists split, targets by number or name."""
    own = F.filter("related_topics", lambda t: ~t["source_section"].isin(*links.INFERRED))
    d = commands.select(F.col("section").alias("src"), F.posexplode(own).alias("place", "t"))
    d = d.select("src", "place", "t", F.posexplode(links.declared(F.col("t.title"))).alias("pos", "entry")).withColumn("key", key_of("entry.title"))
    d = d.join(names.targets.select(F.col("name").alias("key"), "sections"), "key", "left")
    none = F.array().cast("array<string>")
    said = F.coalesce("t.target_sections", none)
    found = F.when(F.col("entry.section").isNotNull(), F.array("entry.section")).when(F.size(said) > 0, said).otherwise(F.coalesce("sections", none))
    ord_ = F.row_number().over(Window.partitionBy("src").orderBy("place", "pos")) - 1
    or_empty = lambda c: F.coalesce(c, F.lit("")).alias(c.split(".")[1])
    kind = F.when(F.coalesce("t.reference_kind", F.lit("")) == "", F.lit("documented_reference")).otherwise(F.col("t.reference_kind")).alias("reference_kind")
    return d.select("src", ord_.alias("ord"), F.col("entry.title").alias("title"), or_empty("t.description"), or_empty("t.source_section"), F.filter(found, lambda x: x != F.col("src")).alias("target_sections"), none.alias("target_files"), kind)


def enriched(commands: DataFrame) -> DataFrame:
    """Commands with topics that their records declare, texts name, examples call and parameters are about; doing it twice changes nothing."""
    commands = settled(commands, "enrich-commands")
    alias = settled(links.aliases(commands), "enrich-aliases")
    names = links.names_of(alias, commands)
    far = 1_000_000
    t = declared_topics(commands, names).unionByName(links.linked(commands, names).withColumn("ord", F.col("ord") + far))
    p = parameter_topics(commands, alias)
    p = p.select("src", (F.col("pos") + 2 * far).alias("ord"), "title", "description", F.lit("Parameters").alias("source_section"), F.array("section").alias("target_sections"), F.array().cast("array<string>").alias("target_files"), F.lit("parameter_topic").alias("reference_kind"))
    m = links.merged_topics(links.in_context(settled(t, "enrich-topics"), commands).unionByName(settled(p, "enrich-parameters")))
    topic = F.struct(*[c.split()[0] for c in links.TOPIC.split(", ")])
    m = m.groupBy(F.col("src").alias("section")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", topic.alias("t")))), lambda x: x["t"]).alias("__new"))
    d = commands.join(m, "section", "left").withColumn("related_topics", F.coalesce("__new", F.array().cast(corpus.TOPICS))).drop("__new")
    return with_targets(settled(d, "enriched"))


def write_corpus(commands: DataFrame, output: Path, *, schema: str = "repository", metadata: dict | None = None, report: dict | None = None) -> dict:
    """Publishes commands (with warnings, start_page, end_page, ord) as records, Markdown, manifest.json and validation.json; returns counts."""
    c = with_targets(with_files(commands))
    records = corpus.to_json(c, schema).withColumnRenamed("section", "__s")
    rows = c.join(records, F.col("section") == F.col("__s")).withColumn("md", command_markdown())
    with staged(output) as stage:
        (stage / "cmd_corpus").mkdir()
        write_files(rows, stage / "cmd_corpus")
        return finish(c, stage, {"schema": schema} | (metadata or {}), report or {})


def finish(c: DataFrame, stage: Path, metadata: dict, report: dict) -> dict:
    """Writes manifest and report from the driver, entry by entry."""
    entries, issues, counts = [], [], {"commands": 0, "templates": 0, "related_topics": 0, "commands_with_related_topics": 0}
    for r in c.select("file", "section", "title", "start_page", "end_page", "warnings", F.size("clis").alias("n"), F.size("related_topics").alias("k")).orderBy("ord").toLocalIterator():
        entries.append({"file": f"cmd_corpus/{r['file']}", "markdown_file": f"cmd_corpus/{r['file'][:-5]}.md", "section": r["section"], "title": r["title"], "first_page": r["start_page"], "last_page": r["end_page"]})
        if r["warnings"]:
            issues.append({"section": r["section"], "title": r["title"], "pages": [r["start_page"], r["end_page"]], "warnings": list(r["warnings"])})
        for key, n in (("commands", 1), ("templates", r["n"]), ("related_topics", r["k"]), ("commands_with_related_topics", int(r["k"] > 0))):
            counts[key] += n
    for name, value in (("manifest.json", metadata | {"commands": entries}), ("validation.json", report | counts | {"issues": issues})):
        (stage / name).write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return counts | {"commands_with_warnings": len(issues)}


def open_corpus(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """The manifest and the commands of a published corpus, with sections, pages and warnings."""
    root = Path(path)
    manifest = json.loads((root / "manifest.json").read_text(encoding="utf-8"))
    base = lambda c: F.regexp_replace(c, r"^.*/", "")
    e = corpus.manifest_entries(spark, str(root / "manifest.json")).select(base(F.col("file")).alias("file"), F.col("pos").alias("ord"), "section", F.col("title").alias("__t"), F.col("first_page").alias("start_page"), F.col("last_page").alias("end_page"))
    c = corpus.read_records(spark, str(root)).drop("ord").join(e, "file").withColumn("title", F.coalesce("__t", "title")).drop("__t")
    none = F.array().cast("array<string>")
    if not (root / "validation.json").exists():
        return manifest, c.withColumn("warnings", none)
    issue = "issues array<struct<section:string,warnings:array<string>>>"
    w = spark.read.schema(issue).json(str(root / "validation.json"), multiLine=True).select(F.posexplode("issues").alias("i", "x")).groupBy("x.section").agg(F.max_by("x.warnings", "i").alias("warnings"))
    return manifest, c.join(w, "section", "left").withColumn("warnings", F.coalesce("warnings", none))


def enrich_corpus(spark: SparkSession, source: str, output: Path) -> dict:
    """A copy of a corpus with topics built anew; records keep all else that they hold."""
    from ..plans.parsing import validated

    manifest, c = open_corpus(spark, source)
    if c.filter("section IS NULL OR section = ''").limit(1).count() or c.groupBy("section").count().filter("count > 1").limit(1).count():
        raise ValueError("commands need sections of their own")
    c = c.withColumn("warnings", F.filter("warnings", lambda w: ~(w.startswith("unbalanced_syntax:") | w.startswith("unsupported_syntax:"))))
    c = enriched(with_files(c.withColumnRenamed("file", "__old")))
    c = c.withColumn("warnings", validated(c))
    raw = spark.read.text(source, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_name").alias("__old"))
    rows = c.join(raw, "__old").withColumn("json", merged_record("value", F.to_json("related_topics", {"ignoreNullFields": "false"}), F.to_json(grammar.syntax_issues(F.col("clis"))))).withColumn("md", command_markdown())
    report = Path(source) / "validation.json"
    with staged(output) as stage:
        (stage / "cmd_corpus").mkdir()
        write_files(rows, stage / "cmd_corpus")
        return finish(c, stage, manifest, json.loads(report.read_text(encoding="utf-8")) if report.exists() else {})


def export_markdown(spark: SparkSession, source: str, output: Path, title: str | None = None) -> int:
    """Writes a corpus as one Markdown document, row by row; returns the number of commands."""
    manifest, c = open_corpus(spark, source)
    plain = lambda t: t.select(text.prose(F.col("t"))).first()[0]
    one = lambda s: plain(spark.createDataFrame([(" ".join(s.splitlines()),)], "t string"))
    n = F.row_number().over(Window.orderBy("ord"))  # one row for each file
    d = c.withColumn("n", n).select("n", text.prose(F.regexp_replace("title", r"\r?\n", " ")).alias("label"), command_markdown(F.concat(F.lit("command-"), n)).alias("md")).orderBy("n")
    with Path(output).open("x", encoding="utf-8") as out:
        out.write(f"# {one(title or manifest.get('document_title') or 'Command Corpus')}\n\nCommands: {len(manifest['commands'])}.\n\n")
        url = manifest.get("source_url")
        if isinstance(url, str) and url.lower().startswith(("http://", "https://")):
            out.write(f"Source: {one(url)}\n\n")
        out.write("## Contents\n\n")
        for r in d.select("n", "label").toLocalIterator():
            out.write(f"- [{r['label']}](#command-{r['n']})\n")
        out.write("\n")
        count = 0
        for r in d.select("n", "md").toLocalIterator():
            out.write(r["md"] + "\n")
            count += 1
    return count
