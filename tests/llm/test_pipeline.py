"""The pipeline's stages against brute force."""

import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import decontaminate

from . import plain
from .test_operators import DOCS, doc, near_brute, prose

DOCS_COLUMNS = [c.split()[0] for c in DOCS.split(", ")]


def test_benchmarks_drops_a_passage_of_one_item(spark, tmp_path):
    items = [(1, prose(20)), (2, prose(15))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    whole, part = items[0][1], " ".join(items[1][1].split()[3:11])
    rows = [doc(1, f"{prose(9)} {whole} {prose(9)}"), doc(2, f"{prose(9)} {part}"), doc(3, f"{whole} {part}"), doc(4, prose(40)), doc(5, " ".join(whole.split()[:7])), doc(6, None)]
    out = corpus_pipeline.benchmarks(spark, spark.createDataFrame(rows, DOCS), str(tmp_path))
    assert sorted(r["doc_id"] for r in out.collect()) == [4, 5, 6]


def test_near_links_by_five_words(spark):
    rng = random.Random(8)
    rows = []
    for g in range(8):
        base = prose(120, rng).split()
        for i in range(5):
            w = list(base)
            for at in rng.sample(range(120), (0, 1, 3, 6, 9)[i]):
                w[at] = f"w{rng.random()}"
            rows.append(doc(10 * g + i, " ".join(w)))
    two, five = ({i for i, (_, c) in near_brute(rows, k).items() if c == i} for k in (2, 5))
    assert two < five
    out = corpus_pipeline.near(spark, spark.createDataFrame(rows, DOCS), "")
    assert {r["doc_id"] for r in out.collect()} == five


def odd_rows(spark):
    """Two items in separate parts, and documents that share a doc_id (or have none) and a number of words."""
    items = [(1, prose(20)), (2, prose(20)), (3, prose(20)), (4, prose(20))]
    a, b = items[0][1], items[1][1]
    clean = prose(40)
    rows = [doc(None, f"{a} {b}"), doc(None, clean), doc(None, clean), doc(7, f"{b} {prose(20)}"), doc(7, f"{b} {prose(20)}"), doc(7, prose(40)), doc(8, clean), doc(9, None), doc(9, None)]
    return spark.createDataFrame(rows, DOCS), rows, spark.createDataFrame(items, "item_id bigint, text string")


def test_parts_give_each_row_its_own_verdict(spark):
    docs, rows, bench = odd_rows(spark)
    key = lambda s, bench=bench: sorted(((r["id"] or 0, r["n_words"], r["n_hit"], r["items_sha256"], r["n_near"], r["contaminated"]) for r in decontaminate.verdicts(docs, bench, s).collect()))
    one = key(decontaminate.Search())
    assert len(one) == len(rows) and [x[3:] for x in one if x[-1]] != []
    assert key(decontaminate.Search(part_bytes=300)) == one
    assert key(decontaminate.Search(slice=3)) == one
    assert key(decontaminate.Search(block_bytes=100)) == one


def test_items_of_any_id(spark):
    text = [prose(12) for _ in range(4)]
    bench = spark.createDataFrame([(None, text[0]), ("b", text[1]), ("a,1", text[2]), (None, text[3]), ("b", text[0])], "item_id string, text string")
    docs = spark.createDataFrame([doc(1, " x ".join(text)), doc(2, text[3]), doc(None, text[2])], DOCS)
    got = {r["id"]: r for r in decontaminate.verdicts(docs, bench).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {i: (r["n_items"], r["n_hit"], r["items_sha256"]) for i, r in got.items()} == {1: (3, 48, digest("a,1,b")), 2: (1, 12, digest("")), None: (1, 12, digest("a,1"))}


def test_windows_of_common_words_stay_bounded(spark):
    bench = spark.createDataFrame([(1, "no " * 30), (2, "no " * 7 + "yes")], "item_id bigint, text string")
    docs = spark.createDataFrame([doc(1, "no " * 20_000), doc(2, "no " * 20 + "yes"), doc(3, "no " * 7)], DOCS)
    got = {r["id"]: r for r in decontaminate.verdicts(docs, bench, decontaminate.Search(slice=1000)).collect()}
    assert {i: (r["n_hit"], r["n_items"]) for i, r in got.items()} == {1: (20_000, 1), 2: (21, 2), 3: (0, 0)}


def test_decontaminated_judges_rows_without_an_id(spark):
    docs, rows, bench = odd_rows(spark)
    for part_bytes in (8_000_000, 300):
        out = decontaminate.decontaminated(docs, bench, decontaminate.Search(min_items=1, part_bytes=part_bytes))
        left = [r for i, r in enumerate(rows) if i not in (0, 3, 4)]
        assert out.columns == docs.columns
        assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted((r[0] or 0, r[1] or "") for r in left)


def whole_rows():
    """Documents of which every stage drops some."""
    rng = random.Random(12)
    rows, n = [], 0
    items = [(1, prose(18, rng)), (2, prose(12, rng))]

    def add(text, source=None):
        nonlocal n
        n += 1
        rows.append(doc(n, text, rng.choice(("en", "de", None)), source or f"s{rng.randrange(14)}"))

    for _ in range(150):
        add("\n".join(prose(rng.randrange(8, 25), rng) for _ in range(rng.randrange(2, 6))))
    for i in range(25):
        add(f"{prose(30, rng)}\nthis line is everywhere you look\n{prose(20, rng)}", f"s{i % 13}")
    for _ in range(6):
        base = prose(90, rng).split()
        for k in (0, 1, 2, 12):
            for at in rng.sample(range(90), k):
                base[at] = f"w{rng.randrange(10**6)}"
            add(" ".join(base))
    for item in (0, 0, 1):
        add(f"{prose(20, rng)} {items[item][1]} {prose(20, rng)}")
    for text in (None, "", "short", "* | " * 60 + prose(25, rng), f"{prose(10, rng)}\n" * 9, "the of and to in is it that was for " * 8):
        add(text)
    return rows, items


def test_run_agrees_with_plain_python(spark, tmp_path):
    rows, items = whole_rows()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sizes, now = [len(rows)], rows
    for step in (plain.quality, plain.lines, plain.near, lambda r: plain.benchmarks(r, items)):
        now = step(now)
        sizes.append(len(now))
    assert all(a > b for a, b in zip(sizes, sizes[1:], strict=False) if (a, b) != (sizes[1], sizes[2]))  # each stage drops some; lines only cuts texts
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*DOCS_COLUMNS, "copies"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(plain.mixture(now), key=lambda r: r[0])


def test_run_on_empty_tables_and_clashing_columns(spark, tmp_path):
    names = ("copies", "id", "key", "h", "bad", "label", "component_id", "size", "source_size")
    wide = spark.createDataFrame(whole_rows()[0], DOCS).select("*", *[F.lit("x").alias(n) for n in names])
    for name, docs, items in (("none", wide.limit(0), []), ("wide", wide, [])):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.columns == [*wide.columns, "copies_"]
        assert (out.count() > 0) == (name == "wide")
