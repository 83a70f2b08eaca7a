"""Line dedup against a plain count: spreads about the threshold, rows without an id, repeated ids."""

import random

from quarry.llm import line_dedup

from .test_operators import DOCS, doc, prose


def brute(rows, least=10):
    """(doc_id, clean text) of each row."""
    sites, first = {}, {}
    for i, text, _, source, *_ in rows:
        for x in (text or "").split("\n"):
            if len(x.split()) >= 3:
                if source is not None:
                    sites.setdefault(x.strip(), set()).add(source)
                if i is not None:
                    first[x.strip()] = min(i, first.get(x.strip(), i))
    gone = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, text, *_ in rows:
        keep = [x for x in (text or "").split("\n") if not (len(x.split()) >= 3 and x.strip() in gone and (i is None or first[x.strip()] != i))]
        out.append((i if i is not None else -1, None if text is None else "\n".join(keep)))
    return sorted(out, key=repr)


def test_spreads_about_the_threshold_are_exact(spark):
    rng = random.Random(4)
    rows, n = [], 0
    for sites in (8, 9, 10, 11, 12, 40):
        for line in range(6):
            for s in range(sites):
                n += 1
                rows.append(doc(n, f"{prose(6, rng)} {n}\n common  line {sites} {line} \nok\ncommon  line {sites} {line}", source=f"s{s}"))
    rows += [doc(5, f"{prose(4, rng)}\ncommon  line 40 1", source="s1"), doc(5, f"{prose(4, rng)}\ncommon  line 40 1", source="s2"), rows[0], doc(800, None), doc(801, "", source=None), doc(802, "common  line 12 1", source=None)]
    rows += [doc(None, f"{prose(5, rng)}\ncommon  line 40 2", source=f"s{i}") for i in range(4)]
    got = line_dedup.cleaned(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r["row"]["doc_id"] if r["row"]["doc_id"] is not None else -1, r["clean"]) for r in got), key=repr) == brute(rows)


def test_of_rows_without_an_id_one_keeps_the_line(spark):
    rows = [doc(None, f"{prose(5)} {i}\nkept on many sites here", source=f"s{i}") for i in range(15)]
    got = line_dedup.cleaned(spark.createDataFrame(rows + rows[:1], DOCS)).collect()
    assert len({r["row"]["text"] for r in got if r["n_removed"] == 0}) == 1
    assert {r["n_lines"] for r in got} == {2} and sum(r["n_removed"] for r in got) in (14, 15)


def test_long_pages_and_clashing_columns(spark):
    names = ("id", "t", "h", "pos", "bad", "all", "clean", "first_id", "site")
    page = "\n".join("the same line again" for _ in range(20_000))
    docs = spark.createDataFrame([doc(i, page, source=f"s{i}") for i in range(11)], DOCS)
    from pyspark.sql import functions as F

    docs = docs.select("*", *[F.lit("x").alias(n) for n in names])
    out = line_dedup.without_boilerplate(docs)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [0]
