"""The mix against a plain sort of each source: ties, repeated rows, rows without an id, clashing columns."""

import random

from pyspark.sql import functions as F

from quarry.llm import mixing

from .test_operators import DOCS, doc, prose


def brute(rows, m):
    """The number of copies of each row, by sorting each source's rows as `keyed` orders them."""
    ends = {r["s"]: r for r in mixing.cuts(rows, m).collect()}
    out = []
    by = {}
    for r in rows.collect():
        by.setdefault(r["source"], []).append(r)
    for source, own in by.items():
        size = sum(r["size"] for r in own)
        e = ends[source]
        assert e["source_size"] == size
        epochs = int(e["target"] // size) if size else 0
        before, rest = 0, e["target"] - epochs * size
        for r in sorted(own, key=lambda r: (r["key"], r["size"], r["same"])):
            out.append((source or "", r["doc_id"] or -1, r["size"], r["size"] * (epochs + (before + r["size"] / 2 <= rest))))
            before += r["size"]
    return sorted(out)


def test_the_search_for_the_cut_agrees_with_a_sort(spark):
    rng = random.Random(3)
    rows = [doc(i, prose(rng.randrange(0, 30), rng) + " |" * rng.randrange(0, 9), source=rng.choice(("a", "b", "c", None))) for i in range(300)]
    again = prose(7, rng)
    rows += [doc(900, again, source="a")] * 150  # rows that agree in every column
    rows += [doc(901, prose(n % 5, rng), source="b") for n in range(200)]  # an id that repeats
    rows += [doc(None, prose(6, rng), source="c") for n in range(100)] + [doc(None, again, source="c")] * 40 + [doc(None, None, source="d"), doc(5, "", source="d")]
    docs = spark.createDataFrame(rows, DOCS)
    for few, bins in ((3, 4), (50, 16), (10_000, 4096)):
        m = mixing.Mix(few=few, bins=bins)
        keyed = mixing.keyed(docs, m, F.col("doc_id")).cache()
        want = brute(keyed, m)
        got = sorted((r["source"] or "", r["doc_id"] or -1, r["size"], r["taken"]) for r in mixing.mixed(docs, m).collect())
        assert got == want
    m = mixing.Mix(few=3, bins=4)
    out = mixing.mix(docs, m).collect()
    assert sorted((r["source"] or "", r["doc_id"] or -1, len(r["text"].split()), r["copies"] * len(r["text"].split())) for r in out) == [w for w in want if w[3]]


def test_keys_of_rows_without_an_id_differ(spark):
    docs = spark.createDataFrame([doc(None, f"{prose(5)} {i}") for i in range(50)], DOCS)
    assert mixing.keyed(docs, mixing.Mix()).select("key").distinct().count() == 50


def test_maps_and_clashing_columns(spark):
    names = ("copies", "key", "size", "same", "s", "last", "row", "source_size", "target", "bin", "ties")
    docs = spark.createDataFrame([doc(i, prose(9)) for i in range(30)], DOCS).drop("row").select("*", F.create_map(F.lit("a"), "doc_id").alias("m"), *[F.lit("x").alias(n) for n in names])
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "copies_"] and 0 < out.count() <= 30
    assert mixing.mixed(docs).count() == 30
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
