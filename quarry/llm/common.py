"""What the operators of this subpackage share: the shared folder, written tables, key splitting."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as the inside of a regex class.
SPACE = r"\x20\x09-\x0D"
#: Folders of the tables written so far and not deleted.
TABLES: list[str] = []
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quarry-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, lost executors cost nothing, and its size is known."""
    path = f"{shared_dir(df.sparkSession)}/quarry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    TABLES.append(path)
    return out


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes folders of written tables wherever they lie."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if path in TABLES:
            TABLES.remove(path)


def spent(*tables: DataFrame) -> None:
    """Deletes written tables that no plan still to be run reads."""
    for df in tables:
        delete(df.sparkSession, df.written_to)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives a task's memory back once it ends: workers are used again and would keep it."""

    def bounded(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return bounded


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row; a lambda would evaluate a plain expression for each element."""
    return F.transform(F.array(value), body)[0]


def unit(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of their MD5."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def salted(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "inner", salts: int = 32) -> DataFrame:
    """left joined with right on key, where right has each key once; the hot keys' rows are dealt over `salts` parts.

    hot holds the hot keys in a column `key` and must have a proven bound: it is broadcast.
    """
    mark = F.broadcast(hot.select(F.col(key).alias("__hot")))
    spread = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(*[left[c] for c in left.columns]), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    a = left.join(mark, left[key] == F.col("__hot"), "left").withColumn("__salt", spread).drop("__hot")
    b = right.join(mark, right[key] == F.col("__hot"), "left")
    b = b.withColumn("__salt", F.explode(F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("__hot")
    return a.join(b, [key, "__salt"], how).drop("__salt")


def heavy(df: DataFrame, key: str, part: float = 0.001, least: int = 1000) -> DataFrame:
    """The keys with more than this part of df's rows: 1 / part of them at most, so they pass through the driver."""
    total = df.count()
    n = df.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > max(least, part * total)).select(key)
    return df.sparkSession.createDataFrame(n.collect() if total > least else [], n.schema)


def columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, whatever else the table carries."""
    return df.select(*[df[n] for n in names])
