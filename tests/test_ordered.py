import time

from pyspark.sql import functions as F

from quarry.operators import ordered as O


def test_page_ranges_of_a_long_outline(spark):
    """Chapters of 100 sections, 40,000 entries in one document: a look-ahead for each row would take minutes."""
    n = 40_000
    d = spark.range(n).select(F.lit("d").alias("doc_id"), F.col("id").alias("idx"), F.when(F.col("id") % 100 == 0, 1).otherwise(2).alias("level"), (1 + F.floor(F.col("id") / 10)).alias("page"))
    began = time.time()
    found = {r["idx"]: (r["first_page"], r["last_page"]) for r in O.page_ranges(d, F.lit(n), levels=2).collect()}
    assert time.time() - began < 30
    page = lambda i: 1 + i // 10 if i < n else n
    assert found == {i: (page(i), page(i + (100 if i % 100 == 0 else 1))) for i in range(n)}


def test_page_ranges_end_at_the_next_entry_no_deeper(spark):
    rows = [("d", 0, 1, 1), ("d", 1, 2, 2), ("d", 2, 3, 3), ("d", 3, 2, 3), ("d", 4, 1, 7), ("d", 5, 3, 8), ("e", 0, 2, 4), ("e", 1, 1, None), ("e", 2, 1, 6)]
    d = spark.createDataFrame(rows, "doc_id string, idx int, level int, page int")
    found = [tuple(r) for r in O.page_ranges(d, F.lit(9), levels=3).orderBy("doc_id", "idx").select("doc_id", "first_page", "last_page").collect()]
    assert found == [("d", 1, 7), ("d", 2, 3), ("d", 3, 3), ("d", 3, 7), ("d", 7, 9), ("d", 8, 9), ("e", 4, 6), ("e", None, 6), ("e", 6, 9)]
