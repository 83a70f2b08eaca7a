"""Benchmark decontamination with a distributed positional inverted index.

The index shards by document and knows nothing of the test set: each block of documents stores its
dictionary and, for each term, the sorted positions at which the term stands.  It is built once and
written.  A search starts from the postings of a phrase's rarest term in the block, shifts them by
its offset, and intersects them with the other terms' postings, from rare to frequent.  Exact
phrases and proximity matches (all of a phrase's terms within a span) come from the same postings.

The test set is cut into parts of bounded size; one part at a time is sent to the tasks that read
the index.  What a part finds is written by row number, and the parts' results meet there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, spent, written

#: Bytes to words: A-Z lower-cased, `[\x00-\x2F\x3A-\x60\x7B-\x7F]` to blanks.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Search:
    window: int = 8
    #: Words beyond the phrase's own that a proximity match may span.
    slop: int = 4
    min_items: int = 2
    #: Bytes of test text in a part, and of training text in a block.
    part_bytes: int = 16_000_000
    block_bytes: int = 4_000_000
    #: Postings that are held against the others at a time.
    slice: int = 1_000_000


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


class Phrases:
    """The distinct windows of a part of the test set, as arrays of term numbers; items known by their ids as text."""

    def __init__(self, items: list[tuple[str | None, str | None]], s: Search):
        self.terms: dict[bytes, int] = {}
        self.items: list[str | None] = []
        grids, owners = [], []
        for item, text in items:
            w = np.array([self.terms.setdefault(x, len(self.terms)) for x in words(text.encode() if text is not None else None)], np.int32)
            if not len(w):
                continue
            short = np.full(max(s.window, len(w)), -1, np.int32)
            short[: len(w)] = w
            grids.append(np.lib.stride_tricks.sliding_window_view(short, s.window))
            owners.append(np.full(len(grids[-1]), len(self.items), np.int32))
            self.items.append(item)
        grid = np.concatenate(grids) if grids else np.empty((0, s.window), np.int32)
        owner = np.concatenate(owners) if owners else np.empty(0, np.int32)
        order = np.lexsort((owner, *grid.T))
        grid, owner = grid[order], owner[order]
        new = np.concatenate(([True], (grid[1:] != grid[:-1]).any(1)))[: len(grid)]
        self.grid = grid[new].astype(np.int64)
        self.length = (self.grid >= 0).sum(1)
        #: The items of phrase i are owner[first[i]:first[i + 1]].
        self.first = np.append(np.flatnonzero(new), len(owner))
        self.owner = owner

    def of(self, phrase: int) -> list[int]:
        return self.owner[self.first[phrase] : self.first[phrase + 1]].tolist()


@dataclass
class Block:
    """Postings of a block: keys of term and position, sorted; positions number the block's words, documents set apart."""

    keys: np.ndarray
    df: np.ndarray

    SHIFT = np.int64(40)

    @classmethod
    def read(cls, vocabulary: list[bytes], df: np.ndarray, positions: np.ndarray, p: Phrases) -> Block:
        """The postings of the phrases' terms, under the phrases' numbers, from a row of the index."""
        df = df.astype(np.int64)
        ends = np.cumsum(df)
        own = np.array([p.terms.get(x, -1) for x in vocabulary], np.int64)
        mine = np.flatnonzero(own >= 0)
        mine = mine[np.argsort(own[mine])]
        counts = np.zeros(max(1, len(p.terms)), np.int64)
        counts[own[mine]] = df[mine]
        where = [positions[ends[i] - df[i] : ends[i]] for i in mine.tolist()]
        keys = (np.repeat(own[mine], df[mine]) << cls.SHIFT) | (np.concatenate(where) if where else np.empty(0, np.int64))
        return cls(keys, counts)

    def candidates(self, p: Phrases, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase, position of its rarest term, order of its terms from rare to frequent), `most` postings at a time."""
        for low in range(0, len(p.grid), most):
            grid = p.grid[low : low + most]
            df = np.where(grid >= 0, self.df[grid], np.iinfo(np.int64).max)
            live = np.flatnonzero(df.min(1) > 0)
            if not len(live):
                continue
            order = np.argsort(df[live], axis=1, kind="stable")
            term = grid[live, order[:, 0]]
            n = self.df[term]
            first = np.searchsorted(self.keys, term << self.SHIFT)
            ends = np.cumsum(n)
            for at in range(0, int(ends[-1]), most):
                each = np.arange(at, min(at + most, int(ends[-1])))
                i = np.searchsorted(ends, each, "right")
                key = self.keys[first[i] + each - (ends[i] - n[i])]
                yield live[i] + low, key & ((np.int64(1) << self.SHIFT) - 1), order[i]

    def phrases(self, p: Phrases, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, start) of every exact match."""
        for phrase, at, order in self.candidates(p, most):
            start = at - order[:, 0]
            for k in range(1, p.grid.shape[1]):
                if not len(phrase):
                    break
                column = order[:, k]
                term = p.grid[phrase, column]
                key = (term << self.SHIFT) | np.maximum(start + column, 0)
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = (term < 0) | ((self.keys[i] == key) & (start + column >= 0))
                phrase, start, order = phrase[ok], start[ok], order[ok]
            yield phrase, start

    def near(self, p: Phrases, slop: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, position of its rarest term): all its terms, as often as it has them, within its length and slop words."""
        span = p.length + slop
        for phrase, at, order in self.candidates(p, most):
            for k in range(1, p.grid.shape[1]):
                if not len(phrase):
                    break
                term = p.grid[phrase, order[:, k]]
                low = np.searchsorted(self.keys, (term << self.SHIFT) | np.maximum(at - span[phrase] + 1, 0))
                high = np.searchsorted(self.keys, ((term << self.SHIFT) | (at + span[phrase] - 1)) + 1)
                ok = (term < 0) | (high > low)
                phrase, at, order = phrase[ok], at[ok], order[ok]
            good = [self.spans(p.grid[i, : p.length[i]], int(x), int(span[i])) for i, x in zip(phrase.tolist(), at.tolist(), strict=True)]
            good = np.array(good, bool)
            yield phrase[good], at[good]

    def spans(self, terms: np.ndarray, at: int, span: int) -> bool:
        """Whether some `span` words that hold position `at` have all the terms, each as often as here."""
        need = dict(zip(*np.unique(terms, return_counts=True), strict=True))
        here = []
        for t in need:
            a, b = np.searchsorted(self.keys, [(int(t) << 40) | max(at - span + 1, 0), ((int(t) << 40) | (at + span - 1)) + 1])
            here += [(int(k) & ((1 << 40) - 1), t) for k in self.keys[a:b]]
        here.sort()
        for first, _ in here:
            if first <= at and first + span > at:
                got: dict[int, int] = {}
                for pos, t in here:
                    if first <= pos < first + span:
                        got[t] = got.get(t, 0) + 1
                if all(got.get(t, 0) >= n for t, n in need.items()):
                    return True
        return False


INDEX = "rows array<bigint>, ids array<string>, starts array<bigint>, counts array<bigint>, terms binary, df binary, postings binary"


def indexer(s: Search):
    """A function for mapInArrow: row number, id, text to a row of INDEX for each block of documents.

    `terms` are the block's words set apart by blanks, `df` how often each stands there, and
    `postings` their positions, term by term.
    """
    gap = s.window + s.slop

    def blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
        at, total = 0, 0
        for i, x in enumerate(column):
            n = len(x.as_buffer() or b"") if x.is_valid else 0
            if total and total + n > s.block_bytes:
                yield at, i
                at, total = i, 0
            total += n
        if at < len(column):
            yield at, len(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for a, b in blocks(texts):
                number: dict[bytes, int] = {}
                at, starts, counts, ids, where = 0, [], [], [], []
                for text in texts.slice(a, b - a):
                    w = words(text.as_py())
                    starts.append(at)
                    counts.append(len(w))
                    ids.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int32, len(w)))
                    where.append(np.arange(at, at + len(w), dtype=np.int64))
                    at += len(w) + gap
                if at >= 2**31:
                    raise ValueError("a block holds too many words")
                ids, where = np.concatenate(ids), np.concatenate(where)
                order = np.argsort(ids, kind="stable")
                df = np.bincount(ids, minlength=len(number))
                one = lambda x, kind: pa.array([x], kind)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([one(batch.column(0).slice(a, b - a).to_pylist(), longs), one(batch.column(1).slice(a, b - a).to_pylist(), pa.list_(pa.string())), one(starts, longs), one(counts, longs), one(b" ".join(number), pa.binary()), one(df.astype("<i4").tobytes(), pa.binary()), one(where[order].astype("<i4").tobytes(), pa.binary())], ["rows", "ids", "starts", "counts", "terms", "df", "postings"])

    return run


FOUND = "row bigint, spans array<struct<a:bigint,b:bigint>>, items array<string>, near_items array<string>"


def searcher(p: Phrases, s: Search):
    """A function for mapInArrow: rows of INDEX to the rows in which a phrase or a near match stands: spans of hits, items, near items."""
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, starts, terms, df, postings in zip(*(batch.column(i) for i in range(5)), strict=True):
                block = Block.read(terms.as_py().split(), np.frombuffer(df.as_py(), "<i4"), np.frombuffer(postings.as_py(), "<i4"), p)
                if not len(block.keys) or not len(p.grid):
                    continue
                begins = starts.values.to_numpy()
                hits: dict[int, set] = {}
                spans: dict[int, list] = {}
                close: dict[int, set] = {}
                for phrase, start in block.phrases(p, s.slice):
                    doc = np.searchsorted(begins, start, "right") - 1
                    for d, i, x in zip(doc.tolist(), phrase.tolist(), (start - begins[doc]).tolist(), strict=True):
                        hits.setdefault(d, set()).update(p.of(i))
                        spans.setdefault(d, []).append((x, x + int(p.length[i])))
                    for d in set(doc.tolist()):
                        spans[d] = merged(spans[d])
                for phrase, at in block.near(p, s.slop, s.slice):
                    for d, i in zip((np.searchsorted(begins, at, "right") - 1).tolist(), phrase.tolist(), strict=True):
                        close.setdefault(d, set()).update(p.of(i))
                live = sorted(hits.keys() | close.keys())
                named = lambda found: pa.array([[p.items[i] for i in sorted(found.get(d, ()))] for d in live], pa.list_(pa.string()))
                ranges = pa.array([[{"a": x, "b": y} for x, y in spans.get(d, ())] for d in live], span)
                yield pa.RecordBatch.from_arrays([rows.values.take(pa.array(live, pa.int64())), ranges, named(hits), named(close)], ["row", "spans", "items", "near_items"])

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def parts(bench: DataFrame, s: Search) -> Iterator[list[tuple[str | None, str]]]:
    """The test set in parts of bounded bytes, one after the other; one alone is on the driver at a time."""
    b = bench.select(F.col("item_id").cast("string").alias("item"), "text").filter("text IS NOT NULL")
    total = b.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-2 * total // s.part_bytes))
    b = written(b.select("*", F.pmod(F.xxhash64("item", "text"), F.lit(n)).alias("part")), "bench-parts")
    for i in range(n):
        yield sorted(((r["item"], r["text"]) for r in b.filter(F.col("part") == i).toLocalIterator()), key=repr)
    spent(b)


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns with a unique number for each row in `row`; the numbers hold only once they are written."""
    return docs.select(F.monotonically_increasing_id().alias("row"), *columns)


def indexed(rows: DataFrame, s: Search = Search()) -> DataFrame:
    """The index of rows with row, id (as text) and text, written."""
    return written(rows.select("row", "id", "text").mapInArrow(frugal(indexer(s)), INDEX), "bench-index")


def found_in(index: DataFrame, bench: DataFrame, s: Search) -> DataFrame:
    """row, spans, items, near_items of the rows of the index that hold a phrase or a near match of the test set; written."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    each = []
    for items in parts(bench, s):
        d = index.select("rows", "starts", "terms", "df", "postings").mapInArrow(frugal(searcher(Phrases(items, s), s)), FOUND)
        each.append(written(d, "bench-found"))
    both = reduce(DataFrame.unionByName, each).groupBy("row").agg(flat("spans"), flat("items"), flat("near_items"))
    both = written(both, "bench-merged")
    spent(*each)
    return both


def results(index: DataFrame, bench: DataFrame, s: Search) -> DataFrame:
    """row, id, n_words, spans, items, near_items of every row of the index."""
    every = index.select(F.explode(F.arrays_zip("rows", "ids", "counts")).alias("x")).select(F.col("x.rows").alias("row"), F.col("x.ids").alias("id"), F.col("x.counts").alias("n_words"))
    found = found_in(index, bench, s).withColumnRenamed("row", "r")
    none = lambda c: F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c)
    return every.join(found, F.col("row") == F.col("r"), "left").select("row", "id", "n_words", none("spans"), none("items"), none("near_items"))


def searched(docs: DataFrame, bench: DataFrame, s: Search = Search()) -> DataFrame:
    """id, n_words, spans (of words hit, ends exclusive), items and near_items (sorted ids, as text).

    Null and empty texts have no words and no hits; items without words match nothing, and items
    that repeat count once.  Items without an id count as one, whose name is null.  Repeated rows
    of docs, rows that share a doc_id and rows without one are searched each on its own.  Without
    items nothing is hit; an empty table gives no rows.  Columns beside doc_id and text are not read.
    """
    index = indexed(numbered(docs, F.col("doc_id").cast("long").cast("string").alias("id"), F.col("text")), s)
    return results(index, bench, s).withColumn("id", F.col("id").cast("long")).drop("row")


def verdicts(docs: DataFrame, bench: DataFrame, s: Search = Search()) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, n_near, contaminated."""
    return judged(searched(docs, bench, s), s)


def judged(d: DataFrame, s: Search) -> DataFrame:
    """The verdicts on what a search found.  The digest is over the named items."""
    named = F.array_join(F.array_sort(F.filter(F.array_distinct("items"), lambda x: x.isNotNull())), ",")
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["b"] - F.greatest(x["a"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], x["b"]).alias("end"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    n_items = F.size(F.array_distinct("items")).cast("long")
    return d.select(
        "id",
        "n_words",
        F.aggregate("spans", zero, step)["n"].alias("n_hit"),
        n_items.alias("n_items"),
        F.sha2(named.cast("binary"), 256).alias("items_sha256"),
        F.size(F.array_distinct("near_items")).cast("long").alias("n_near"),
        (n_items >= s.min_items).alias("contaminated"),
    )


def contaminated_ids(docs: DataFrame, bench: DataFrame, s: Search = Search()) -> DataFrame:
    return verdicts(docs, bench, s).filter("contaminated").select("id").distinct()


def decontaminated(docs: DataFrame, bench: DataFrame, s: Search = Search()) -> DataFrame:
    """The documents without the contaminated ones; each row is judged by its own text, whatever its doc_id.

    A verdict rests on the text alone, so the index knows rows by the text's MD5, and the documents
    are held against the digests of contaminated texts: no text is copied.  Null texts stay.
    """
    digest = F.md5(F.col("text").cast("binary"))
    index = indexed(numbered(docs, digest.alias("id"), F.col("text")), s)
    bad = judged(results(index, bench, s), s).filter("contaminated").select(F.col("id").alias("__bad")).distinct()
    bad = written(bad, "bench-bad")
    spent(index)
    return docs.join(bad, digest == F.col("__bad"), "left_anti")
