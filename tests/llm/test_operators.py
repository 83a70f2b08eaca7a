"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re

import pytest

from quarry.llm import decontaminate, language_id, licenses, line_dedup, mixing, near_dedup, quality_classifier, quality_rules, toxicity, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, row string, kept int"
RNG = random.Random(1)
VOCAB = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti") for b in ("na", "ter", "vo", "sil", "mun", "dor")]


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, len(text or ""), "clash", "clash", 1)


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of every odd kind."""
    rows = [doc(1, None), doc(2, ""), doc(3, "  \n\t "), doc(4, prose(30), None, None), doc(5, "x " * 5000), doc(6, prose(40)), doc(None, prose(25), "de", "s1")]
    return spark.createDataFrame(rows + [rows[5]], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_quality_rules(spark, odd, none):
    text = prose(9) + "\n" + prose(20) + "\n" + prose(9)
    twice = prose(12)
    rows = [doc(10, f"{twice}\n{text}\n{twice}"), doc(11, text), doc(12, "*** " * 60 + prose(30))] + [doc(100 + i, prose(200)) for i in range(20)]
    d = spark.createDataFrame(rows, DOCS)
    got = {r["row"]["doc_id"]: r for r in quality_rules.measured(d).collect()}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1])
        win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        hit = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(8)}
        lines = [x for x in r[1].split("\n") if x.strip()]
        g = got[r[0]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r[1])), len(lines) - len(set(lines)), len(hit))
    assert not got[12]["kept"] and got[100]["kept"] and got[10]["n_repeat_words"] == 24
    out = quality_rules.keep_good(odd)
    assert out.columns == odd.columns and {r["doc_id"] for r in out.collect()} <= {4, 6, None}
    assert quality_rules.keep_good(none).count() == 0


def test_line_dedup(spark, odd, none):
    rows = [doc(i, f"{prose(6)}\nall rights kept here\nok\n{prose(5)}", source=f"s{i}") for i in range(12)] + [doc(50 + i, "only on one site here\n" + prose(4), source="s1") for i in range(15)]
    d = spark.createDataFrame(rows, DOCS)
    got = {r["row"]["doc_id"]: r for r in line_dedup.cleaned(d).collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["n_removed"] == 1 and "all rights" not in got[i]["clean"] for i in range(1, 12))
    assert all(got[50 + i]["n_removed"] == 0 for i in range(15))
    assert sorted(r["doc_id"] or 0 for r in line_dedup.without_boilerplate(odd).collect()) == [0, 1, 2, 3, 4, 5, 6, 6]
    assert line_dedup.without_boilerplate(none).count() == 0


def near_brute(rows, k=2):
    sets = {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets[r[0]] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup(spark, odd, none):
    rng = random.Random(5)
    base = prose(120, rng).split()
    rows = [doc(0, " ".join(base)), doc(1, None), doc(2, ""), doc(3, "one"), doc(4, "ONE")]
    for i in range(10, 130):  # a large bucket of near copies of which some link with none
        w = list(base)
        for _ in range(rng.choice((2, 4, 9, 14))):
            w[rng.randrange(len(w))] = f"w{rng.random()}"
        rows.append(doc(i, " ".join(w)))
    rows += [doc(200 + i, prose(50, rng)) for i in range(30)] + [doc(300, " ".join(base).upper())]
    d = spark.createDataFrame(rows, DOCS)
    m = near_dedup.MinHash(small=8, block=16)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.grouped(d, m).collect()}
    assert got == near_brute(rows)
    out = near_dedup.one_of_each(odd)
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6] and out.columns == odd.columns
    assert near_dedup.one_of_each(none).count() == 0


def test_estimate_is_close():
    m = near_dedup.MinHash()
    import numpy as np
    import pyarrow as pa

    a, b = " ".join(f"a{i}" for i in range(500)), " ".join(f"a{i}" for i in range(50, 550))
    out = next(near_dedup.signer(m)(iter([pa.RecordBatch.from_pydict({"id": [1, 2], "text": [a, b]})])))
    x, y = (np.array(v, np.int64).view(np.uint64) for v in out.column(5).to_pylist())
    lanes = lambda v: (v[:, None] >> (np.arange(16, dtype=np.uint64) * np.uint64(4))) & np.uint64(15)
    same = (lanes(x) == lanes(y)).mean()
    assert abs((same - 1 / 16) / (15 / 16) - 449 / 549) < 0.13


def test_decontaminate(spark, odd, none):
    items = [(1, prose(20)), (2, prose(12)), (3, "short One!"), (4, None), (5, "..."), (6, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [doc(1, f"{prose(5)} {items[0][1].upper()} {prose(3)} {items[1][1]}"), doc(2, "a short, one"), doc(3, prose(50)), doc(4, " ".join(items[0][1].split()[3:11])), doc(5, None), doc(6, " ".join(reversed(items[1][1].split()[:8])))]
    d = spark.createDataFrame(rows, DOCS)
    got = {r["id"]: r for r in decontaminate.verdicts(d, bench).collect()}
    w = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = {tuple(x[i : i + 8]): n for n, t in items for x in [w(t)] if x for i in range(max(1, len(x) - 7))}
    for r in rows:
        x, hit, found = w(r[1]), set(), set()
        for k, n in windows.items():
            for i in range(len(x) - len(k) + 1):
                if tuple(x[i : i + len(k)]) == k:
                    hit |= set(range(i, i + len(k)))
                    found.add(n)
        g = got[r[0]]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (g["n_words"], g["n_hit"], g["n_items"], g["items_sha256"], g["contaminated"]) == (len(x), len(hit), len(found), digest, len(found) >= 2)
    assert got[6]["n_items"] == 0 and got[6]["n_near"] == 1
    parts = decontaminate.Search(part_bytes=400, block_bytes=200)
    key = lambda rows: sorted((r["id"], r["n_hit"], r["items_sha256"]) for r in rows)
    assert key(decontaminate.verdicts(d, bench, parts).collect()) == key(got.values())
    assert decontaminate.decontaminated(odd, bench).count() == 8 and decontaminate.decontaminated(none, bench).count() == 0
    assert decontaminate.verdicts(odd, spark.createDataFrame([], "item_id bigint, text string")).filter("contaminated").count() == 0


def test_licenses(spark, odd, none):
    assert len(licenses.rules()) >= 200
    rows = [doc(1, "Under the GNU General-Public License, version 2 or later. CC-BY CC BY-SA 3.0; the MIT License"), doc(2, "apache license " * 3), doc(3, None), doc(4, "nothing")]
    got = {r["id"]: r for r in licenses.scanned(spark.createDataFrame(rows, DOCS)).collect()}
    assert [(b["start"], b["label"]) for b in got[1]["bases"]] == [(2, "gpl"), (10, "cc-by"), (12, "cc-by"), (18, "mit")]
    assert {"gpl-2-or-later", "cc-by", "cc-by-sa-3.0", "mit"} <= {f["label"] for f in got[1]["found"]}
    assert "gpl" not in {f["label"] for f in got[1]["found"]}
    assert [b["start"] for b in got[2]["bases"]] == [0, 2, 4] and not got[4]["found"] and got[3]["n_words"] == 0
    assert licenses.scanned(odd).count() == 8 and licenses.scanned(none).count() == 0


def test_language_id(spark, odd, none):
    en = lambda: " ".join(RNG.choice(("the", "thing", "with", "other", "this")) for _ in range(30))
    de = lambda: " ".join(RNG.choice(("der", "schön", "über", "nicht", "auch")) for _ in range(30))
    d = spark.createDataFrame([doc(i, en() if i % 2 else de(), "en" if i % 2 else "de") for i in range(120)] + [doc(500, "123"), doc(501, None)], DOCS)
    got = {r["id"]: r for r in language_id.identified(d, language_id.train(d)).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") and 0 <= got[i]["score"] <= 1 for i in range(120))
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und"
    assert language_id.identified(none, language_id.train(none)).count() == 0
    assert language_id.identified(odd, language_id.train(odd)).count() == 8


def test_toxicity(spark, odd, none):
    rows, labels = [], []
    for i in range(200):
        bad = i % 4 == 0
        rows.append(doc(i, prose(40) + (" loser " if bad else " winter ") + prose(5)))
        labels.append((i, int(bad), 1))
    hidden = ["l0s3r", "l.o.s.e.r", "l o s e r", "looooser", "L0SER!!"]
    rows += [doc(1000 + i, f"{prose(10)} {w} {prose(10)}") for i, w in enumerate(hidden)] + [doc(2000, prose(60)), doc(2001, "a b c d"), doc(2002, None)]
    d, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    model = toxicity.train(d, known)
    got = {r["id"]: r["score"] for r in toxicity.scored(d, model).collect()}
    assert all(got[1000 + i] >= 0.3 for i in range(len(hidden)))
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(200)) and max(got[2000], got[2001], got[2002]) < 0.3
    empty = toxicity.train(none, known.limit(0))
    assert toxicity.scored(odd, empty).filter("score >= 0.3").count() == 0


def test_mixing(spark, odd, none):
    rows = [doc(i, prose(RNG.randrange(1, 30)), source=RNG.choice(("a", "b", "c", "d", None))) for i in range(400)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS)).collect()
    sums, taken = {}, {}
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        sums[r["source"]], taken[r["source"]] = (r["source_size"], r["target"]), taken.get(r["source"], 0) + r["taken"]
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(n for n, _ in sums.values()), dict.fromkeys(order, 0.0), set(order)
    while total > 1e-9 and free:  # share by weight, cap, share the excess anew
        w = sum(weight[s] for s in free)
        for s in free:
            target[s] += total * weight[s] / w
        total = sum(max(0, target[s] - 2 * sums[s][0]) for s in free)
        target = {s: min(t, 2 * sums[s][0]) for s, t in target.items()}
        free = {s for s in free if target[s] < 2 * sums[s][0]}
    for s in order:
        assert abs(sums[s][1] - target[s]) < 1e-3 and abs(taken[s] - target[s]) <= 30
    assert mixing.mixed(odd).count() == 8 and mixing.mix(none).count() == 0


def test_warc(spark):
    pages = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://a/5", "é" * 5000), (6, "z", "<p>x</p>")]
    d = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    w = warc.Warc(chunk=1000)
    folder, archives = warc.write_archives(d, w)
    chunks = warc.read_archives(folder, archives, w).cache()
    got = {r["page_id"]: r for r in warc.record_table(chunks).collect()}
    import base64

    for i, _, html in pages:
        data = (html or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert {i: r["refers_to"] for i, r in got.items()} == {1: None, 2: 1, 3: None, 4: 3, 5: None, 6: 1}
    parts = chunks.filter("page_id = 5").orderBy("chunk_no").collect()
    assert len(parts) == 10 and b"".join(bytes(r["data"]) for r in parts) == ("é" * 5000).encode()
    folder, archives = warc.write_archives(d.limit(0))
    assert warc.record_table(warc.read_archives(folder, archives)).count() == 0


def test_quality_classifier(spark, odd, none):
    rows = [doc(i, prose(40) if i % 3 else "### $$$ " * 20 + prose(5), source=f"s{i % 4}") for i in range(240)]
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id bigint, quality int, toxic int")
    got = {r["id"]: r for r in quality_classifier.classified(d, labels).collect()}
    assert all(got[i]["kept"] == (i % 3 > 0) for i in range(240))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert quality_classifier.classified(odd, labels).count() == 8
    assert quality_classifier.classified(none, labels).count() == 0


def test_sql_of_the_pipeline_is_declared():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "benchmarks", "mixture"] and corpus_pipeline.ORACLE_SQL is None
