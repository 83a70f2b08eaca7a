"""The corpus pipeline: rules, line dedup, near dedup, decontamination and mixing, one stage after the other.

Each stage's result is written before the next stage is called with it, reread.  So a stage begins by
deleting the tables that the one before it left in the shared folder, unless its documents still read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from quarry.llm.common import TABLES, delete, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: The tables that the last stage wrote for its result.
LEFT: list[str] = []


def cleared(spark: SparkSession, docs: DataFrame) -> None:
    """Deletes what the last stage left, if docs don't read it."""
    names = {path.rsplit("/", 1)[1] for path in LEFT}
    if names and not any(part in names for f in docs.inputFiles() for part in f.split("/")):
        delete(spark, *LEFT)
    LEFT.clear()


def stage(work: Stage) -> Stage:
    """A stage that clears up after the one before it."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        cleared(spark, docs)
        before = set(TABLES)
        out = work(spark, docs, sf_dir)
        LEFT.extend(p for p in TABLES if p not in before)
        return out

    return run


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep.

    Null, empty and very short texts fail the rules.  Each row is judged by its own text, so repeated
    rows and rows that share an id or have none stay or go each on its own.  An empty table stays
    empty; other columns pass through whatever their names.  So do they in all stages.
    """
    return quality_rules.keep_good(docs)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without boilerplate lines; n_chars follows the text.

    Null texts stay; a document of which no word is left goes.  Of the documents that have a
    boilerplate line the first by doc_id keeps it, in all its rows; those without an id are never the first.
    """
    return line_dedup.without_boilerplate(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words; op3's two are its query's own.

    Documents without words, and those without an id, are linked with nothing and stay.  Rows that
    share an id are one document, of which one row stays.
    """
    return near_dedup.one_of_each(docs, near_dedup.MinHash(shingle=5))


@stage
def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of any benchmark item: one is a leak here, while op4's column asks for two.

    Each row is judged by its own text; null and empty texts have no passages and stay.  Items
    without words match nothing, and without items all documents stay.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), decontaminate.Search(min_items=1))


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents that are taken, with `copies`.

    Documents without words are never taken.  Null sources are one source.  Repeated rows count
    each; of rows that agree in every column as many are taken as the budget reaches.
    """
    return mixing.mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("benchmarks", benchmarks), ("mixture", mixture)]

#: Near dedup spreads component labels until they settle; SQL of one statement can't follow it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = written(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
