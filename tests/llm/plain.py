"""The pipeline's stages in plain Python, over rows as `doc` makes them."""

import hashlib
import math
import re
from collections import Counter

from quarry.llm.quality_rules import CLASSES, WORDS

from .test_line_dedup import brute as line_brute
from .test_operators import near_brute

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def words(t):
    return [w for w in WHITE.split(t or "") if w]


def distance(p, q):
    """Jensen-Shannon distance of two lists of shares, in bits."""
    total = 0.0
    for x, y in zip(p, q, strict=True):
        m = (x + y) / 2
        total += sum(v * math.log2(v / m) for v in (x, y) if v > 0) / 2
    return math.sqrt(max(0.0, total))


def classes(t):
    n = [len(re.findall("[a-z]", t)), len(re.findall(r"[\x20\x09-\x0D]", t)), *(len(re.findall(p, t)) for _, p in CLASSES)]
    return [*n, len(t) - sum(n)]


def common(t):
    n = Counter(w for w in words(t) if w in WORDS)
    return [n[w] for w in WORDS] + [len(words(t)) - sum(n.values())]


def quality(rows):
    sums = {}
    for _, t, lang, *_ in rows:
        for k in {lang, None}:
            a, b = sums.setdefault(k, ([0] * 7, [0] * (len(WORDS) + 1)))
            sums[k] = ([x + y for x, y in zip(a, classes(t or ""), strict=True)], [x + y for x, y in zip(b, common(t), strict=True)])
    out = []
    for r in rows:
        t, w = r[1] or "", words(r[1])
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often = Counter(windows)
        repeated = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(8)}
        if len(w) < 20 or 100 * len(repeated) > 30 * len(w):
            continue
        ref = sums[r[2] if r[2] is not None and sum(sums[r[2]][1]) >= 1000 else None]
        share = lambda n: [x / sum(n) for x in n]
        if len(t) >= 100 and distance(share(classes(t)), share(ref[0])) > 0.3:
            continue
        if len(w) >= 50 and distance(share(common(t)), share(ref[1])) > 0.5:
            continue
        out.append(r)
    return out


def lines(rows):
    clean = dict(line_brute(rows))
    out = []
    for r in rows:
        t = clean[r[0]]
        if t == r[1] or words(t):
            out.append((r[0], t, *r[2:4], len(t), *r[5:]))
    return out


def near(rows):
    first = near_brute(rows, 5)
    return [r for r in rows if first[r[0]][1] == r[0]]


def benchmarks(rows, items):
    w = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    phrases = {tuple(x[i : i + 8]) for _, t in items for x in [w(t)] if x for i in range(max(1, len(x) - 7))}
    hit = lambda x: any(tuple(x[i : i + n]) in phrases for n in {len(p) for p in phrases} for i in range(len(x) - n + 1))
    return [r for r in rows if not hit(w(r[1]))]


def mixture(rows):
    """The rows taken, with their copies."""
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, free = 1.5 * sum(size.values()), dict.fromkeys(order, 0.0), set(order)
    while left > 1e-9 and free:
        unit = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += unit * weight[s]
        left = sum(max(0, target[s] - 2 * size[s]) for s in free)
        target = {s: min(t, 2 * size[s]) for s, t in target.items()}
        free = {s for s in free if target[s] < 2 * size[s]}

    def key(r):
        u = (int(hashlib.md5(f"7:{r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / max(0.1, 1 - 5 * len(re.findall(r"[#*$%&|<>]", r[1])) / max(1, len(r[1])))

    out = []
    for s in order:
        epochs = int((target[s] + 1e-6) // size[s]) if size[s] else 0
        rest, before = target[s] - epochs * size[s], 0
        for r in sorted((r for r in rows if r[3] == s), key=key):
            n = len(words(r[1]))
            copies = epochs + (before + n / 2 <= rest)
            before += n
            if copies and n:
                out.append((*r, copies))
    return out
