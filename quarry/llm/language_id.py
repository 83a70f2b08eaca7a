"""Language ID with string kernels.

A blended-spectrum kernel compares the sets of character n-grams that two texts hold.  Nystroem
landmarks, a bounded sample of labelled rows, give each text a vector of kernel values, and
one-versus-rest kernel ridge regression is fitted on these.  Scoring multiplies batches of
presence vectors with the landmarks' and the result with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, written

U = np.uint64


@dataclass(frozen=True)
class Kernel:
    #: Orders of the n-grams and what each weighs in the blend.
    weights: tuple[float, ...] = (0.5, 1.0, 1.0)
    #: Rows of each language that are learned from, of these the landmarks, and characters of all languages' rows, shared evenly.
    per_language: int = 200
    landmarks: int = 24
    max_chars: int = 20_000_000
    ridge: float = 1e-3
    #: The softmax of scores is taken at this sharpness.
    sharpness: float = 8.0
    batch: int = 128
    seed: int = 5


def grams(text: str, orders: int) -> list[np.ndarray]:
    """For each order, the distinct n-grams: up to three code points packed in one number.

    Text is lower-cased; all that isn't a letter is one blank.
    """
    c = np.frombuffer((" " + "".join(x if x.isalpha() else " " for x in text.lower()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) if not text.isascii() else ascii_points(text)
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    out, packed = [], c
    for n in range(orders):
        if n:
            packed = (packed[:-1] << U(21)) | c[n:]
        out.append(np.unique(packed))
    return out


TO_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))


def ascii_points(text: str) -> np.ndarray:
    return np.frombuffer(b" " + text.encode().translate(TO_LETTERS) + b" ", np.uint8).astype(U)


class Model:
    """Fitted on labelled texts; small enough to be sent to the tasks."""

    def __init__(self, texts: list[str], langs: list[str], k: Kernel = Kernel()):
        if len(k.weights) > 3:
            raise ValueError("three code points fit in a number")
        self.k = k
        self.langs = sorted(set(langs))
        self.majority = max(self.langs, key=langs.count) if langs else "und"
        sets = [grams(t, len(k.weights)) for t in texts]
        taken: dict[str, int] = {}
        marks = []
        for i, lang in enumerate(langs):
            if taken.get(lang, 0) < k.landmarks:
                taken[lang] = taken.get(lang, 0) + 1
                marks.append(i)
        # The grams of all landmarks are the columns of presence vectors; others can add nothing to a kernel value.
        orders = range(len(k.weights))
        self.vocabulary = [np.unique(np.concatenate([sets[i][n] for i in marks])) if marks else np.empty(0, U) for n in orders]
        self.offset = np.cumsum([0] + [len(v) for v in self.vocabulary])
        self.marks = np.zeros((self.offset[-1], len(marks)), np.float32)
        norms = []
        for j, i in enumerate(marks):
            for n in orders:
                self.marks[self.offset[n] + np.searchsorted(self.vocabulary[n], sets[i][n]), j] = k.weights[n]
            norms.append(self.norm(sets[i]))
        if marks:
            self.marks /= np.array(norms, np.float32)
        if not self.langs:
            return
        kernel = self.values(sets)
        square = kernel[marks]
        w, v = np.linalg.eigh((square + square.T) / 2)
        good = w > 1e-6 * w.max()
        self.map = v[:, good] / np.sqrt(w[good])
        x = np.column_stack([kernel @ self.map, np.ones(len(texts))])
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        balance = np.array([len(langs) / (len(self.langs) * langs.count(lang)) for lang in langs])[:, None]
        self.weights = np.linalg.solve(x.T @ (balance * x) + k.ridge * len(texts) * np.eye(x.shape[1]), x.T @ (balance * y))

    def norm(self, sets: list[np.ndarray]) -> float:
        return float(np.sqrt(sum(w * len(s) for w, s in zip(self.k.weights, sets, strict=True)))) or 1.0

    def values(self, sets: list[list[np.ndarray]]) -> np.ndarray:
        """Kernel values of the texts' gram sets with the landmarks', in batches."""
        out = []
        for at in range(0, len(sets), self.k.batch):
            part = sets[at : at + self.k.batch]
            present = np.zeros((len(part), self.offset[-1]), np.float32)
            for row, own in zip(present, part, strict=True):
                for n, s in enumerate(own):
                    v = self.vocabulary[n]
                    i = np.minimum(np.searchsorted(v, s), max(len(v) - 1, 0))
                    row[self.offset[n] + i[v[i] == s]] = 1
                row /= self.norm(own)
            out.append(present @ self.marks)
        return np.concatenate(out).astype(np.float64)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score); `und` with score 0 for texts without a letter."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        live = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not live or not self.langs:
            return [(self.majority, 0.0) if i in set(live) else x for i, x in enumerate(out)]
        s = np.column_stack([self.values([grams(texts[i], len(self.k.weights)) for i in live]) @ self.map, np.ones(len(live))]) @ self.weights
        e = np.exp(self.k.sharpness * (s - s.max(1, keepdims=True)))
        best, p = s.argmax(1), e.max(1) / e.sum(1)
        for i, b, x in zip(live, best.tolist(), p.tolist(), strict=True):
            out[i] = (self.langs[b], round(x, 6))
        return out


def train(docs: DataFrame, k: Kernel = Kernel()) -> Model:
    """Fits a model on a sample of the rows that are not held out, bounded by rows and characters of each language.

    Each language has an equal share of `max_chars`, 20,000 characters at least, and texts beyond
    its share are not learned from; rows without a language, and texts without a letter, neither.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    counts = written(counts, "language-counts")
    share = max(20_000, k.max_chars // max(1, counts.count()))
    dice = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))), F.lit(k.seed)), F.lit(2**30)) / float(2**30)
    few = F.least(F.lit(1.0), F.lit(1.3 * k.per_language) / F.col("n"))
    sample = rows.filter(F.char_length("text") <= share).withColumn("dice", dice).join(counts, "lang").filter(F.col("dice") < few).select("dice", "lang", "text")
    taken, used, texts, langs = {}, {}, [], []
    for r in sorted(sample.toLocalIterator()):
        lang, text = r["lang"], r["text"]
        if taken.get(lang, 0) < k.per_language and used.get(lang, 0) + len(text) <= share:
            taken[lang] = taken.get(lang, 0) + 1
            used[lang] = used.get(lang, 0) + len(text)
            texts.append(text)
            langs.append(lang)
    return Model(texts, langs, k)


def scorer(model: Model):
    """A function for mapInArrow: id, text to id, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), model.k.batch):
                part = batch.slice(at, model.k.batch)
                lang, score = zip(*model.predict(part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score)], ["id", "lang_pred", "score"])

    return run


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """id, lang_pred, score of each row.

    `und` stands for null and empty texts and those without a letter.  Without any labelled row
    every other text is `und` too.  Repeated rows score alike; columns beside doc_id and text are
    not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(scorer(model), "id bigint, lang_pred string, score double")
