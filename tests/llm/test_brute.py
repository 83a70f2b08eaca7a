"""Models against brute force: lattice paths, rules without gate, kernels of sets, posteriors in plain Python."""

import math
import random
import time
from itertools import product

import numpy as np

from quarry.llm import language_id, licenses, quality_classifier, toxicity
from quarry.llm.common import held_out

from .test_operators import DOCS, doc, prose


def paths(token, lm, ch=toxicity.Channel()):
    """The best score of each string that a token may stand for."""
    ways, last = [], ""
    for c in token:
        options = [(c, ch.log_keep)] if c.isalpha() and c not in toxicity.STANDS else []
        options += [(x, ch.log_sign) for x in toxicity.STANDS.get(c, "")]
        if c.isalpha() and c in toxicity.STANDS:
            options.append((c, ch.log_sign))
        if c in toxicity.JOINERS or not options:
            options.append(("", ch.log_drop))
        elif c == last:
            options.append(("", ch.log_repeat))
        ways.append(options)
        last = c
    out = {}
    for way in product(*ways):
        a = b = 0
        score = 0.0
        for x, cost in way:
            score += cost
            if x:
                score += lm.log[a, b, toxicity.letter(x)]
                a, b = b, toxicity.letter(x)
        word = "".join(x for x, _ in way)
        out[word] = max(out.get(word, -math.inf), score + lm.log[a, b, 0])
    return out


def test_decoding_finds_the_best_of_all_paths():
    rng = random.Random(2)
    lm = toxicity.Letters(np.array([rng.random() ** 4 * 50 for _ in range(toxicity.N**3)]))
    for _ in range(150):
        token = "".join(rng.choice("abll0011@.-$3e6!s") for _ in range(rng.randrange(1, 9)))
        found = paths(token, lm)
        assert math.isclose(found[toxicity.decode(token, lm)], max(found.values()), abs_tol=1e-9)


def test_decoding_long_tokens():
    rng = random.Random(3)
    lm = toxicity.Letters(np.array([rng.random() for _ in range(toxicity.N**3)]))
    short = "".join(rng.choice("abcdefgh0123") for _ in range(3000))
    whole = toxicity.decode(short, lm)
    assert len(whole) >= 1000 and toxicity.decode("1" * 3000, lm)
    began = time.perf_counter()
    toxicity.decode("".join(rng.choice("ABCDEFabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400_000)).lower(), lm)
    assert time.perf_counter() - began < 10


def test_contradicting_labels_count_as_toxic(spark):
    rows = [doc(i, f"{prose(20)} {'loser' if i % 2 else 'winter'}") for i in range(80)]
    labels = [(i, i % 2, 0) for i in range(80)] + [(i, 0, 0) for i in range(80)]
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    docs = spark.createDataFrame(rows, DOCS)
    one, two = (toxicity.train(docs, k).lexicon for k in (known, known.orderBy("toxic")))
    assert one == two and "loser" in one


def test_licenses_against_all_rules_and_pairs():
    rng = random.Random(4)
    names = "GPL LGPL AGPL MPL Apache-2.0 GPLv2 MIT CC-BY-SA 3.0 4.0 version 2 or later any the License General Public GNU Apache Redistribution and use in source SPDX-License-Identifier: only BSD 3-Clause".split()
    for _ in range(300):
        line, n = licenses.line_of(" ".join(rng.choice(names) for _ in range(rng.randrange(1, 40))).encode())
        found = [(m.start(), m.end(), r.label, r.priority) for r in licenses.rules() for m in r.pattern.finditer(line)]
        at = lambda o: line.count(b" ", 0, o) - 1
        inside = lambda d, e: e[0] <= d[0] and d[1] <= e[1]
        covers = lambda e, d: inside(d, e) and (e[3] > d[3] or e[3] == d[3] and (e[1] - e[0] > d[1] - d[0] or (e[0], e[1]) == (d[0], d[1]) and e[2] < d[2]))
        want = {(at(d[0]), at(d[1]) + 1, d[2]) for d in found if not any(covers(e, d) for e in found)}
        got = {(d.start, d.end, d.label) for d in licenses.detections(line)}
        assert got == want


def test_license_spellings():
    labels = lambda t: {d.label for d in licenses.detections(licenses.line_of(t.encode())[0])}
    for t, want in {
        "GPLv2": "gpl-2", "GPLv3 or later": "gpl-3-or-later", "LGPLv2.1": "lgpl-2.1", "Apache-2.0": "apache-2.0", "AGPLv3+": "agpl-3",
        "GPL version 2 or (at your option) any later version": "gpl-2-or-later", "SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2-or-later", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause", "MPL-2.0": "mpl-2.0",
        "Apache License, Version 2.0": "apache-2.0", "GNU General Public License v3.0": "gpl-3", "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa-4.0",
    }.items():
        assert labels(t) == {want}, t
    assert labels("apache helicopters and epl matches, mpl 200") == set()


def test_kernels_are_those_of_sets():
    rng = random.Random(5)
    vocabulary = {"en": "the thing with other this".split(), "de": "der schön über nicht auch".split(), "fr": "le être dans où mais".split()}
    texts = [(" ".join(rng.choice(v) for _ in range(12)), lang) for lang, v in vocabulary.items() for _ in range(15)]
    k = language_id.Kernel(landmarks=5)
    model = language_id.Model([t for t, _ in texts], [x for _, x in texts], k)

    def grams(t):
        t = " " + "".join(c if c.isalpha() else " " for c in t.lower()) + " "
        t = " ".join(t.split()).join("  ") if t.strip() else " "
        return [{t[i : i + n] for i in range(len(t) - n + 1)} for n in (1, 2, 3)]

    def value(x, y):
        dot = lambda a, b: sum(w * len(p & q) for w, p, q in zip(k.weights, a, b, strict=True))
        a, b = grams(x), grams(y)
        return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))

    marks = [t for lang in vocabulary for t in [t for t, x in texts if x == lang][: k.landmarks]]
    kernel = np.array([[value(t, m) for m in marks] for t, _ in texts])
    square = np.array([[value(t, m) for m in marks] for t in marks])
    w, v = np.linalg.eigh(square)
    good = w > 1e-6 * w.max()
    x = np.column_stack([kernel @ (v[:, good] / np.sqrt(w[good])), np.ones(len(texts))])
    langs = sorted(vocabulary)
    y = np.array([[1.0 if lang == a else -1.0 for a in langs] for _, lang in texts])
    weights = np.linalg.inv(x.T @ x + k.ridge * len(texts) * np.eye(x.shape[1])) @ x.T @ y
    new = ["the other thing", "über der nicht this", "mais où le", "schön with être"]
    scores = np.column_stack([np.array([[value(t, m) for m in marks] for t in new]) @ (v[:, good] / np.sqrt(w[good])), np.ones(len(new))]) @ weights
    for (lang, p), s in zip(model.predict(new), scores, strict=True):
        e = np.exp(k.sharpness * (s - s.max()))
        assert lang == langs[int(s.argmax())] and abs(p - e.max() / e.sum()) < 2e-3


def test_every_language_is_learned(spark):
    words = [f"{a}{b}{a}" for a in "bcdfghjklm" for b in "aeiou"]
    rows = [doc(40 * i + j, " ".join([w] * 5), f"x{i:02}") for i, w in enumerate(words) for j in range(4)] + [doc(5, "a" * 30_000, "long")]
    model = language_id.train(spark.createDataFrame(rows, DOCS), language_id.Kernel(max_chars=1000))
    assert len(model.langs) == len(words)


def test_posteriors_in_plain_python(spark):
    rng = random.Random(6)
    rows = [doc(i, prose(rng.randrange(5, 60), rng) + (" ###" * rng.randrange(0, 30) if i % 3 == 0 else ""), rng.choice(("en", "de", None)), rng.choice(("a", "b", "c", None))) for i in range(300)]
    labels = [(i, int(i % 3 > 0) if rng.random() < 0.9 else int(i % 3 == 0), 0) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, DOCS)
    b = quality_classifier.Bayes()
    got = {r["id"]: r for r in quality_classifier.classified(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), b).collect()}
    from pyspark.sql import functions as F

    bins = {r[0]: (tuple(r[1]), r[2]) for r in docs.select("doc_id", quality_classifier.binned(F.col("text")), held_out(F.col("doc_id"))).collect()}
    known = {i: q for i, q, _ in labels if not bins[i][1]}
    good, n = sum(known.values()), len(known)
    prior = (good + 1) / (n + 2)
    table = {}
    for i, q in known.items():
        for f in enumerate(bins[i][0]):
            g, m = table.get(f, (0, 0))
            table[f] = (g + q, m + 1)
    odds = {f: math.log((g + 1) / (good + 2) / ((m - g + 1) / (n - good + 2))) for f, (g, m) in table.items()}
    logit = lambda p: math.log(p / (1 - p))
    expit = lambda x: 1 / (1 + math.exp(-x))
    ev = {i: b.damping * sum(odds.get(f, 0.0) for f in enumerate(x)) for i, (x, _) in bins.items()}
    wy = {i: (1.0, float(known[i])) if i in known else (b.soft, expit(ev[i] + logit(prior))) for i in bins}
    site = {r[0]: (r[3], r[2]) for r in rows}

    def summed(key):
        out = {}
        for i in bins:
            g, m = out.get(key(i), (0.0, 0.0))
            out[key(i)] = (g + wy[i][0] * wy[i][1], m + wy[i][0])
        return out

    def strength(sites, center):
        total = sum(m for _, m in sites.values())
        mean = sum(m * center(k) for k, (_, m) in sites.items()) / total
        spread = sum(m * (g / m - center(k)) ** 2 for k, (g, m) in sites.items()) / total
        chance = mean * (1 - mean)
        return max(b.least, min(b.most, chance / max(1e-6, spread - chance * len(sites) / total) - 1))

    hosts, paths_ = summed(lambda i: site[i][0]), summed(lambda i: site[i])
    every = sum(g for g, _ in hosts.values()) / sum(m for _, m in hosts.values())
    kh = strength(hosts, lambda k: every)
    rate = {h: (g + kh * every) / (m + kh) for h, (g, m) in hosts.items()}
    kp = strength(paths_, lambda k: rate[k[0]])
    for i in bins:
        w, y = wy[i]
        (hg, hn), (g, m) = hosts[site[i][0]], paths_[site[i]]
        host = (hg - w * y + kh * every) / (hn - w + kh)
        path = (g - w * y + kp * host) / (m - w + kp)
        shift = max(-math.log(b.site_bound), min(math.log(b.site_bound), logit(path) - logit(every)))
        want = expit(ev[i] + logit(prior) + shift)
        assert abs(got[i]["score"] - want) < 2e-6 and abs(got[i]["host_rate"] - host) < 2e-6 and abs(got[i]["path_rate"] - path) < 2e-6
