"""Toxicity behind a noisy channel.

Writers hide words: letters become digits and signs, stand apart, or are drawn out.  A disguised
token is a lattice: each character may stand for some letters, for none, or repeat the one before.
Viterbi decoding under a character trigram model (counted over all documents, mixed with the
lexicon's own) restores the likeliest letters, and the restored text is scored with a lexicon of
words and word beginnings that was learned from labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, written

#: What characters may stand for, as `sign letters`.
SIGNS = """
0 o | 1 il | 2 z | 3 e | 4 a | 5 s | 6 gb | 7 t | 8 b | 9 g | @ a | $ s | ! i | + t | ( c | < c | € e | £ l | ¡ i
а a | е e | о o | р p | с c | у y | х x | і i | ѕ s | α a | ε e | ο o | ν v
"""
STANDS = {sign: letters for x in SIGNS.replace("\n", " | ").split(" | ") if x.strip() for sign, letters in [x.split()]} | {"|": "il"}
#: Characters that may stand between letters and mean nothing.
JOINERS = frozenset(".-_*~'`^/\\,:;=​‌‍­")
#: Classes of the language model: 0 for the edge, 1-26 for a-z, 27 for any other letter.
N = 28
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
APART = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")


@dataclass(frozen=True)
class Channel:
    log_sign: float = math.log(0.3)
    log_drop: float = math.log(0.2)
    log_repeat: float = math.log(0.3)
    log_keep: float = math.log(0.7)


@dataclass(frozen=True)
class Toxic:
    #: Rows that the lexicon is learned from, at most.
    toxic_rows: int = 4000
    clean_rows: int = 8000
    #: Beginnings of words of these lengths are features beside whole words.
    beginnings: tuple[int, ...] = (4, 5, 6, 7)
    min_rows: int = 6
    min_part: float = 0.004
    min_precision: float = 0.75
    threshold: float = 0.3
    #: What the lexicon's own trigrams weigh in the language model.
    own: float = 0.3
    seed: int = 3


def letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


class Letters:
    """A character trigram model with add-one smoothing."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(N, N, N).astype(float) + 0.1
        self.log = np.log(c / c.sum(2, keepdims=True))

    @cached_property
    def rows(self) -> list[list[float]]:
        """The logarithms by the two letters before, as plain numbers."""
        return self.log.reshape(N * N, N).tolist()

    def mixed(self, words: Iterator[str], part: float) -> Letters:
        c = np.zeros(N**3)
        for w in words:
            x = [0, 0, *map(letter, w), 0]
            for i in range(len(x) - 2):
                c[(x[i] * N + x[i + 1]) * N + x[i + 2]] += 1
        own = Letters(c)
        out = Letters(np.zeros(N**3))
        out.log = np.log((1 - part) * np.exp(self.log) + part * np.exp(own.log)) if c.any() else self.log
        return out


def letters(node: tuple | None, stop: tuple | None = None) -> str:
    """The letters of a path back to `stop`."""
    out = []
    while node is not stop:
        node, c = node
        out.append(c)
    return "".join(reversed(out))


def decode(token: str, lm: Letters, ch: Channel = Channel()) -> str:
    """The likeliest letters behind a lower-case token; '' if there may be none.

    Paths are chains of back-pointers.  What all of them share is set aside whenever one is left,
    or their length has doubled since that was last looked at, so the work grows with the token.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    done: list[str] = []
    last, since, look = "", 0, 1024
    log = lm.rows
    for c in token:
        options = [(c, ch.log_keep)] if c.isalpha() and c not in STANDS else []
        options += [(x, ch.log_sign) for x in STANDS.get(c, "")]
        if c.isalpha() and c in STANDS:
            options.append((c, ch.log_sign))
        drop = ch.log_drop if c in JOINERS or not options else ch.log_repeat if c == last else None
        numbered = [(x, cost, letter(x)) for x, cost in options]
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (p, node) in states.items():
            row = log[a * N + b]
            for x, cost, k in numbered:
                q = p + cost + row[k]
                if (b, k) not in new or q > new[b, k][0]:
                    new[b, k] = (q, (node, x))
            if drop is not None:
                q = p + drop
                if (a, b) not in new or q > new[a, b][0]:
                    new[a, b] = (q, node)
        states, last, since = new, c, since + 1
        if since >= 64 and len(states) == 1 or since >= look:
            paths = {s: letters(node) for s, (_, node) in states.items()}
            shared = commonprefix(list(paths.values()))
            done.append(shared)
            rest = {s: path[len(shared) :] for s, path in paths.items()}
            states = {s: (p, chain(rest[s])) for s, (p, _) in states.items()}
            since, look = max(map(len, rest.values())), max(1024, 2 * max(map(len, rest.values())))
    _, best = max(((p + log[a * N + b][0], letters(node)) for (a, b), (p, node) in states.items()), default=(0.0, ""))
    return "".join(done) + best


def chain(path: str) -> tuple | None:
    node = None
    for c in path:
        node = (node, c)
    return node


def plain(token: str) -> str:
    """A token without signs at its ends."""
    return token if token.isalpha() else EDGE.sub("", token)


def disguised(core: str) -> bool:
    """Whether letters may be hidden: signs among letters, or a letter three times on end."""
    if core.isalpha():
        return any(a == b == c for a, b, c in zip(core, core[1:], core[2:], strict=False))
    return any(c.isalpha() for c in core) or sum(c in STANDS for c in core) > 2


class Restorer(dict):
    """Tokens to the words that they may stand for; cleared before it grows large."""

    def __init__(self, lm: Letters, reduce):
        super().__init__()
        self.lm, self.reduce = lm, reduce

    def __missing__(self, token: str):
        if len(self) > 400_000:
            self.clear()
        self[token] = out = self.reduce(self.restored(token))
        return out

    def restored(self, token: str) -> list[str]:
        t = token.lower()
        if not t.isascii():
            t = unicodedata.normalize("NFKC", t).lower()
        core = plain(t)
        out = [core] if core else []
        if core and disguised(core):
            out.append(decode(core, self.lm))
        tail = t[len(t.rstrip("".join(STANDS))) :]
        if core and core != t and (0 < len(tail) <= 2 or t[0] in STANDS) and len(set(t)) > 1:
            out.append(decode(t, self.lm))
        return [x for x in dict.fromkeys(out) if x]


def tokens(text: str) -> set[str]:
    """The tokens of a text, and runs of single characters that stand apart as one each."""
    found = set(text.split())
    if sum(len(t) == 1 for t in found) > 2:
        found.update("".join(m.group().split()) for m in APART.finditer(text))
    return found


def features(word: str, beginnings: tuple[int, ...]) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in beginnings if len(word) > n]


def trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all documents; sums of partitions' counts, at most N^3 rows."""
    table = np.zeros(0x110000 // 0x400, np.uint8)  # code points from U+0400 on by blocks of 0x400
    low = np.array([letter(chr(c).lower()) if len(chr(c).lower()) == 1 else 27 for c in range(0x400)], np.int64)
    for i in range(1, len(table)):
        table[i] = 27 if chr(i * 0x400 + 0x10).isalpha() else 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    p = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
                    x = np.where(p < 0x400, low[np.minimum(p, 0x3FF)], table[p >> 10]).astype(np.int64)
                    x = x[np.concatenate(([True], (x[1:] > 0) | (x[:-1] > 0)))]
                    # Words have two edges before them, as in decoding.
                    x = np.repeat(x, np.where(x == 0, 2, 1))
                    if len(x) > 2:
                        total += np.bincount((x[:-2] * N + x[1:-1]) * N + x[2:], minlength=N**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": at.astype(np.int32), "n": total[at]})

    sums = docs.select("text").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(N**3)
    for r in sums.collect():  # N^3 rows at most
        out[r["code"]] = r["n"]
    return out


@dataclass
class Model:
    lexicon: dict[str, float]
    lm: Letters
    prior: float
    t: Toxic

    def restorer(self) -> Restorer:
        def strongest(words: list[str]) -> tuple[str, float] | None:
            found = [(self.lexicon[f], w) for w in words for f in features(w, self.t.beginnings) if f in self.lexicon]
            return (max(found)[1], max(found)[0]) if found else None

        return Restorer(self.lm, strongest)

    def score(self, text: str | None, words: Restorer) -> tuple[float, list[str]]:
        """Chance that a text is toxic, from the distinct restored words that the lexicon has; and these words."""
        found = dict(x for x in map(words.__getitem__, tokens(text or "")) if x)
        clean = 1.0 - self.prior
        for p in found.values():
            clean *= 1.0 - p
        return 1.0 - clean, sorted(found)


def train(docs: DataFrame, labels: DataFrame, t: Toxic = Toxic()) -> Model:
    """Learns the lexicon from a bounded sample of labelled rows that are not held out, and counts letters over all documents.

    Of labels that contradict each other, for one doc_id or for one text, the toxic one counts; rows
    without a label or an id are not learned from.  Without labelled rows the lexicon is empty.
    """
    lm = Letters(trigrams(docs))
    known = labels.select(F.col("doc_id").alias("k"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IS NOT NULL AND k IS NOT NULL").groupBy("k").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("k")))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = {1: min(1.0, t.toxic_rows / max(1, n.get(1, 0))), 0: min(1.0, t.clean_rows / max(1, n.get(0, 0)))}
    dice = F.pmod(F.xxhash64(F.col("k"), F.lit(t.seed)), F.lit(2**30)) / float(2**30)
    some = written(known.filter(dice < F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0])), "toxic-sample")
    rows = docs.select("doc_id", "text").join(some, docs["doc_id"] == some["k"]).groupBy("text").agg(F.max("toxic").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Restorer(lm, lambda x: [f for w in x for f in features(w, t.beginnings)])
        bad, good = Counter(), Counter()
        docs_bad = docs_good = 0
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (bad if toxic == 1 else good).update({f for w in tokens(text or "") for f in words[w]})
                docs_bad, docs_good = docs_bad + (toxic == 1), docs_good + (toxic != 1)
        keys = list(bad.keys() | good.keys())
        yield pa.RecordBatch.from_pydict({"f": keys + [""], "bad": pa.array([bad[k] for k in keys] + [docs_bad], pa.int64()), "good": pa.array([good[k] for k in keys] + [docs_good], pa.int64())})

    sums = rows.mapInArrow(count, "f string, bad bigint, good bigint").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sums = written(sums, "toxic-features")
    total = sums.filter("f = ''").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    least = max(t.min_rows, t.min_part * (total["bad"] or 0))
    weight = lambda k: 1.0 / parts[k] if parts[k] else 1.0
    bad, good = F.col("bad") * weight(1), F.col("good") * weight(0)
    precision = bad / (bad + good + 2.0 * weight(1))
    strong = sums.filter((F.col("bad") >= least) & (F.col("f") != "")).select("f", precision.alias("p")).filter(F.col("p") >= t.min_precision)
    lexicon = {r["f"]: min(0.98, r["p"]) for r in strong.collect()}  # features of toxic_rows rows at most, each of min_rows of them
    prior = 0.02
    return Model(lexicon, lm.mixed((f.rstrip("*") for f in lexicon), t.own), prior, t)


def scorer(model: Model):
    """A function for mapInArrow: id, text to id, score, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.restorer()
        for batch in batches:
            found = [model.score(text, words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([round(s, 6) for s, _ in found], pa.float64()), pa.array([w for _, w in found], pa.list_(pa.string()))], ["id", "score", "words"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """id, score (0 to 1) and the restored words that it rests on.

    Null and empty texts get the lowest score, as do all without labelled rows.  Repeated rows
    score alike; columns beside doc_id and text are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(scorer(model), "id bigint, score double, words array<string>")
