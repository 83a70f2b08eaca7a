"""The thin queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_id, licenses, line_dedup, mixing, near_dedup, quality_classifier, quality_rules, toxicity, warc
from .common import held_out, table
from .sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, those removed, and the MD5 of what is left."""
    d = line_dedup.cleaned(table(spark, sf_dir, "documents"))
    return d.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.md5(F.col("clean").cast("binary")).alias("clean_md5"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    d = toxicity.scored(docs, model)
    return d.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= model.t.threshold).cast("int").alias("predicted"), F.size("words").alias("n_words_found"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = near_dedup.grouped(table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return d.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = licenses.scanned(table(spark, sf_dir, "documents"))
    starts = F.transform("bases", lambda b: b["start"])
    base = F.transform("bases", lambda b: b["label"])
    named = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    doubt = F.aggregate("found", F.lit(1.0), lambda a, x: a * (1 - x["weight"]))
    doubt = F.aggregate("bases", doubt, lambda a, x: a * F.lit(0.4))
    return d.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("bases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.concat(base, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.round(1 - doubt, 6).alias("score"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = language_id.identified(docs, language_id.train(docs))
    return d.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mixed(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.record_table(warc.read_archives(folder, archives))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_classifier.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return d.withColumnRenamed("id", "doc_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.measured(table(spark, sf_dir, "documents"), ["doc_id"])
    return d.select("row.doc_id", *quality_rules.MEASURES, "class_distance", "word_distance", "base_failed", "kept")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_toxicity, op3_near_dedup, op4_decontaminate, op5_license_scan, op6_language_id, op7_mix, op8_warc, op9_quality_classifier, op10_quality_rules, pipeline)}
