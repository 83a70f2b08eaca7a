"""Near duplicates against brute force where large buckets stay open."""

import random

from quarry.llm import near_dedup

from .test_operators import DOCS, doc, near_brute, prose


def crowd(n, rng):
    """Copies of one text with many edits each, of which few link with another."""
    base = prose(200, rng).split()
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(200), rng.choice((3, 14, 22, 30))):
            w[at] = f"w{rng.randrange(10**9)}"
        rows.append(doc(i, " ".join(w)))
        if i % 40 == 7:  # a link that no leader sees
            w[rng.randrange(200)] = "changed"
            rows.append(doc(10_000 + i, " ".join(w)))
    return rows


def test_a_crowd_in_which_few_link(spark):
    rows = crowd(500, random.Random(9))
    want = near_brute(rows)
    assert len({c for _, c in want.values()}) > 100
    docs = spark.createDataFrame(rows, DOCS)
    for m in (near_dedup.MinHash(), near_dedup.MinHash(small=2, block=64)):
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.grouped(docs, m).collect()}
        assert got == want


def test_rows_that_share_an_id_leave_the_least_text(spark):
    rows = [doc(1, "b c d"), doc(1, "a b c"), doc(1, "c d e"), doc(2, None), doc(2, "x y"), doc(None, "p q"), doc(None, "p q")]
    out = near_dedup.one_of_each(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == [(0, "p q"), (0, "p q"), (1, "a b c"), (2, "")]
