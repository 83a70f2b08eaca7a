"""Command corpora: JSON records in either schema, their manifest, Markdown, and publication that never overwrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text

PAIR = "array<struct<{}:string,Info:string>>"
TOPICS = "array<struct<title:string,description:string,source_section:string,target_sections:array<string>,target_files:array<string>,reference_kind:string>>"
RECORD = f"PageTitle string, CLIs array<string>, FuncDef string, ParentView array<string>, ParentViews array<string>, ParaDef array<struct<Parameters:string,Paras:string,Info:string>>, Examples array<array<string>>, UsageGuidelines string, ExtraInfo string, related_topics {TOPICS}"
MANIFEST = "document_title string, source_url string, commands array<struct<file:string,markdown_file:string,section:string,title:string,first_page:int,last_page:int>>"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records below a folder with `file` and the columns of commands, in natural order of their names (`ord`).

    A record with the views' keys of both schemas, or without templates, is an error.
    """
    d = spark.read.schema(RECORD).json(path, multiLine=True, mode="FAILFAST", recursiveFileLookup=True, pathGlobFilter="*.json")
    d = d.select("*", F.col("_metadata.file_name").alias("file")).filter(~F.col("file").isin("manifest.json", "validation.json"))
    both = F.col("ParentView").isNotNull() & F.col("ParentViews").isNotNull()
    d = d.withColumn("CLIs", F.when(both, F.raise_error(F.lit("a record has the keys of both schemas")).cast("array<string>")).when(F.col("CLIs").isNull(), F.raise_error(F.lit("a record has no CLIs")).cast("array<string>")).otherwise(F.col("CLIs")))
    none = F.array().cast("array<string>")
    return d.select(
        "file",
        F.row_number().over(Window.orderBy(text.natural_key(F.col("file")))).alias("ord"),  # one row for each file
        F.coalesce("PageTitle", F.get("CLIs", F.lit(0)), F.lit("Command")).alias("title"),
        F.col("CLIs").alias("clis"),
        F.coalesce("FuncDef", F.lit("")).alias("function"),
        F.coalesce("ParentView", "ParentViews", none).alias("views"),
        F.transform(F.coalesce("ParaDef", F.array().cast("array<struct<Parameters:string,Paras:string,Info:string>>")), lambda p: F.struct(F.coalesce(p["Parameters"], p["Paras"]).alias("name"), p["Info"].alias("info"))).alias("parameters"),
        F.coalesce("Examples", F.array().cast("array<array<string>>")).alias("examples"),
        F.coalesce("UsageGuidelines", F.lit("")).alias("usage_guidelines"),
        F.coalesce("ExtraInfo", F.lit("")).alias("extra"),
        F.coalesce("related_topics", F.array().cast(TOPICS)).alias("related_topics"),
    )


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """pos and the entries of a manifest; paths that repeat, are absolute or climb out are errors."""
    e = spark.read.schema(MANIFEST).json(path, multiLine=True, mode="FAILFAST").select(F.posexplode("commands").alias("pos", "c")).select("pos", "c.*")
    e = e.withColumn("n", F.count("*").over(Window.partitionBy("file")))
    bad = F.col("file").isNull() | F.col("file").rlike(r"^/|(^|/)\.\.(/|$)") | (F.col("n") > 1)
    return e.withColumn("file", F.when(bad, F.raise_error(F.concat(F.lit("bad or repeated path: "), F.coalesce("file", F.lit("none")))).cast("string")).otherwise(F.col("file"))).drop("n")


def to_json(commands: DataFrame, schema: str = "repository") -> DataFrame:
    """section and `json`, the record in either schema."""
    if schema not in ("repository", "paper"):
        raise ValueError(f"no such schema: {schema}")
    own = schema == "repository"
    fields = [F.col("title").alias("PageTitle")] if own else []
    fields += [F.col("clis").alias("CLIs"), F.col("function").alias("FuncDef"), F.col("views").alias("ParentView" if own else "ParentViews")]
    fields += [F.transform("parameters", lambda p: F.struct(p["name"].alias("Parameters" if own else "Paras"), p["info"].alias("Info"))).alias("ParaDef")]
    fields += [F.col("examples").alias("Examples"), F.col("usage_guidelines").alias("UsageGuidelines"), F.col("extra").alias("ExtraInfo"), F.col("related_topics").alias("related_topics")]
    return commands.select("section", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))


def markdown(anchor: Column | None = None) -> Column:
    """One command as Markdown."""
    blocks = lambda c, empty: F.when(F.size(c) > 0, F.array_join(c, "\n\n")).otherwise(F.lit(empty))
    or_else = lambda c, empty: F.when(c != "", text.prose(c)).otherwise(F.lit(empty))
    line = lambda c: F.replace(F.replace(text.prose(c), F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit("<br>"))
    rows = F.concat(F.lit("| Parameter | Description / Values |\n| --- | --- |\n"), F.array_join(F.transform("parameters", lambda p: F.concat(F.lit("| "), line(p["name"]), F.lit(" | "), line(p["info"]), F.lit(" |"))), "\n"))
    parts = [
        F.concat(F.lit('<a id="'), anchor, F.lit('"></a>')) if anchor is not None else F.lit(None).cast("string"),
        F.concat(F.lit("## "), text.prose(F.regexp_replace("title", r"\r?\n", " "))),
        F.lit("### Function"),
        or_else(F.col("function"), "Not specified."),
        F.lit("### Syntax"),
        blocks(F.transform("clis", text.code_block), "Not extracted."),
        F.lit("### Modes / Views"),
        F.when(F.size("views") > 0, F.array_join(F.transform("views", lambda v: F.concat(F.lit("- "), text.prose(v))), "\n")).otherwise("Not specified."),
        F.lit("### Parameters"),
        F.when(F.size("parameters") > 0, rows).otherwise("No parameters, or parameters were not extracted."),
        F.lit("### Usage Guidelines"),
        or_else(F.col("usage_guidelines"), "Not specified in JSON."),
        F.lit("### Examples"),
        blocks(F.transform("examples", lambda e: text.code_block(F.array_join(e, "\n"))), "Not extracted."),
        F.when(F.col("extra") != "", F.concat(F.lit("### Additional Information\n\n"), text.code_block(F.col("extra")))),
    ]
    return F.concat(F.concat_ws("\n\n", *parts), F.lit("\n"))


def publish(df: DataFrame, path: str) -> None:
    """Writes a table that must not be there yet; the committer makes each task's files appear at once."""
    df.write.mode("errorifexists").json(path)
