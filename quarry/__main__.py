"""Command line: parse HTML topics or event tables into a corpus, export Markdown, add related topics."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import text
from .plans import parsing
from .plans.profiles import profile
from .sources import html, publish


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quarry", description=__doc__)
    do = top.add_subparsers(dest="do", required=True)
    p = do.add_parser("parse", help="a folder of HTML topics, or a Parquet table of events (with outline.parquet beside it)")
    p.add_argument("input")
    p.add_argument("--parser", default="ne40e-rendered")
    p.add_argument("--output", "-o", type=Path, required=True)
    p.add_argument("--section")
    p.add_argument("--first-page", type=int, default=1)
    p.add_argument("--last-page", type=int)
    p.add_argument("--schema", choices=["repository", "paper"], default="repository")
    p.add_argument("--source-url")
    p.add_argument("--strict", action="store_true", help="exit 2 on any warning")
    m = do.add_parser("markdown")
    m.add_argument("input")
    m.add_argument("--output", "-o", type=Path, required=True)
    m.add_argument("--title")
    e = do.add_parser("enrich-related")
    e.add_argument("input")
    e.add_argument("--output", "-o", type=Path, required=True)
    return top


def parsed(spark: SparkSession, a: argparse.Namespace):
    """The commands of the input, within the pages and the section asked for."""
    p = profile(a.parser)
    if a.input.rstrip("/").endswith(".parquet"):
        events = spark.read.parquet(a.input)
        outline = spark.read.parquet(str(Path(a.input).parent / "outline.parquet"))
    else:
        pages = spark.read.text(a.input, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.htm*").select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("path"))
        pages = pages.filter(html.is_command_topic(F.col("html")))
        ranked = pages.withColumn("k", text.natural_key(F.col("path")))
        from pyspark.sql import Window

        topics = ranked.select(F.lit("html").alias("doc_id"), F.row_number().over(Window.orderBy("k")).alias("number"), "html")  # one row for each file
        events = html.topic_events(topics)
        outline = spark.createDataFrame([], parsing.OUTLINE + ", section string")
    if a.first_page < 1 or (a.last_page is not None and a.last_page < a.first_page):
        raise ValueError("the pages must be 1 <= first <= last")
    events = events.filter((F.col("page") >= a.first_page) & (F.col("page") <= (a.last_page or 2**31 - 1)))
    c = parsing.parse(events, outline, p)
    return c.filter(text.in_section(F.col("section"), a.section)) if a.section else c


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 on an error, 2 if --strict found warnings."""
    a = arguments().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        if a.do == "parse":
            found = publish.write_corpus(parsed(spark, a), a.output, schema=a.schema, metadata={"source_file": Path(a.input).name, "source_url": a.source_url, "parser_profile": a.parser})
            print(json.dumps({"output": str(a.output)} | found))
            return 2 if a.strict and found["commands_with_warnings"] else 0
        if a.do == "markdown":
            print(json.dumps({"output": str(a.output), "commands": publish.export_markdown(spark, a.input, a.output, a.title)}))
        else:
            print(json.dumps({"output": str(a.output)} | publish.enrich_corpus(spark, a.input, a.output)))
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
