"""Written tables: plans that many others build on end at a Parquet table in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where that is unset and the master is local."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quarry-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df, computed once: its rows as a written table, from which later plans start."""
    path = f"{shared_folder(df.sparkSession)}/quarry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
