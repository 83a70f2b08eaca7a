"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gives a signature of minima.  Bands of the minima are the
candidate keys; of each minimum only b low bits are retained and packed, and the similarity of a
candidate pair is estimated from the bits that agree, corrected for chance agreement.  Pairs that
may reach the threshold are confirmed on the full sets.

Equal sets are one class from the start.  Within a bucket, members are held against a leader (a
star, not all pairs); only members that are then still in different components are held against
others.  A small bucket is paired across its components.  The members of large ones are banded
anew by longer bands, which only closer texts share, and their buckets are treated alike; what is
large even there is compared in blocks inside tasks.  So each pair of a bucket is either confirmed,
refuted, already connected, or met again in the longer bands.  Components spread by labels;
nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, heavy, salted, spent, written

U = np.uint64
LANES = 0x1111111111111111


@dataclass(frozen=True)
class MinHash:
    shingle: int = 2
    #: Links: 100 * intersection >= percent * union.
    percent: int = 80
    #: 32 bands of 4 minima miss a pair at 0.8 with a chance of 5e-8.
    bands: int = 32
    rows: int = 4
    #: Packed lanes of 4 bits; pairs estimated this far below the threshold (6 standard deviations) are refuted.
    bits: int = 4
    margin: float = 0.24
    #: What leaders leave of buckets up to this size is paired across components; larger ones are banded anew.
    small: int = 32
    #: 96 bands of 8 minima miss a pair at 0.8 with a chance of 2e-8; a pair at 0.5 shares one of them with 0.3.
    long_bands: int = 96
    long_rows: int = 8
    #: What is large in the longer bands too is compared in blocks of so many.
    block: int = 1024
    #: The bands whose leaders come first; those of the others see only what these leave apart.
    first: int = 8
    seed: int = 11


class Words(dict):
    """Hashes of words; cleared before it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: bytes | None, k: int, words: Words) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, U)
    h = np.fromiter(map(words.__getitem__, found), U, len(found))
    if len(h) < k:
        k = len(h)
    out = np.full(len(h) - k + 1, k, U)
    for i in range(k):
        out = mixed(out * U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(out)


SIGNATURE = "id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, packed array<bigint>"


def signer(m: MinHash):
    """A function for mapInArrow: id, text to id, n_shingles, set_a, set_b, bands, packed."""
    n = m.bands * m.rows
    rng = np.random.default_rng(m.seed)
    mul = rng.integers(1, 2**63, n, dtype=np.uint64) * U(2) + U(1)
    add = rng.integers(0, 2**63, n, dtype=np.uint64)
    lanes = 64 // m.bits
    shift = (np.arange(lanes, dtype=np.uint64) * U(m.bits))[None, :]

    def minima(s: np.ndarray) -> np.ndarray:
        out = np.full(n, 2**32 - 1, np.uint64)
        for at in range(0, len(s), 2048):
            np.minimum(out, ((s[at : at + 2048, None] * mul + add) >> U(32)).min(0), out)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                sizes, keys, bands, packed = [], [], [], []
                for text in part.column(1).cast(pa.large_binary()):
                    s = shingles(text.as_py(), m.shingle, words)
                    sizes.append(len(s))
                    keys.append((s.sum(dtype=U), mixed(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)))
                    low = minima(s)
                    band = low.reshape(m.bands, m.rows)
                    key = np.arange(m.bands, dtype=np.uint64)
                    for r in range(m.rows):
                        key = mixed(key * U(0x9E3779B97F4A7C15) + band[:, r])
                    bands.append(key)
                    packed.append(((low & U(2**m.bits - 1)).reshape(-1, lanes) << shift).sum(1, dtype=U))
                each = lambda rows, width: pa.ListArray.from_arrays(pa.array(np.arange(0, (len(part) + 1) * width, width, dtype=np.int32)), pa.array(np.concatenate(rows).view(np.int64)))
                pair = np.array(keys, U).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]), each(bands, m.bands), each(packed, n // lanes)], ["id", "n_shingles", "set_a", "set_b", "bands", "packed"])

    return run


def confirmer(m: MinHash):
    """A function for mapInArrow: a, b and both texts to the a, b that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kept, size = Words(), {}, 0
        for batch in batches:
            good = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(i).cast(pa.large_binary()) for i in (2, 3)), strict=True):
                s = shingles(ta.as_py(), m.shingle, words)
                if (t := kept.get(b)) is None:
                    if size > 2_000_000:
                        kept.clear()
                        size = 0
                    kept[b] = t = shingles(tb.as_py(), m.shingle, words)
                    size += len(t)
                if 100 * min(len(s), len(t)) < m.percent * max(len(s), len(t)):
                    good.append(False)
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * both >= m.percent * (len(s) + len(t) - both) and both > 0)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def estimated(x: Column, y: Column, m: MinHash) -> Column:
    """Similarity from packed low bits: the part of lanes that agree, less the chance of 2^-b that unequal minima do."""
    if m.bits != 4:
        raise ValueError("lanes are of 4 bits")

    def lanes(a: Column, b: Column) -> Column:
        d = a.bitwiseXOR(b)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseOR(F.shiftrightunsigned(d, 3))
        return F.bit_count(d.bitwiseAND(F.lit(LANES)))

    n = m.bands * m.rows
    differ = sum((lanes(x[i], y[i]) for i in range(n * m.bits // 64)), F.lit(0))
    chance = 2.0**-m.bits
    return (1 - differ / F.lit(float(n)) - chance) / (1 - chance)


def components(links: DataFrame) -> DataFrame:
    """id, label: the smallest id that each id of the links a, b reaches.

    Labels pass to neighbours and then jump to their label's label, so long chains take few rounds.
    """
    edges = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, "cc-edges")
    hot = heavy(edges, "a")
    last = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "cc-labels")
    while True:
        labels = last.select("id", "label")
        mine = labels.select(F.col("id").alias("a"), "label")
        sent = salted(edges, mine, "a", hot).groupBy("b").agg(F.min("label").alias("got"))
        near = labels.join(sent, labels["id"] == sent["b"], "left").select("id", F.col("label").alias("was"), F.least("label", F.coalesce("got", "label")).alias("l"))
        near = written(near, "cc-near")
        top = heavy(near, "l")
        far = near.select(F.col("id").alias("l"), F.col("l").alias("next"))
        now = written(salted(near, far, "l", top, "left").select("id", F.coalesce("next", "l").alias("label"), "was"), "cc-labels")
        spent(near, last)
        last = now
        if last.filter("label <> was").isEmpty():
            spent(edges)
            return last.select("id", "label")


def signed(docs: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """The signature table of the documents."""
    return written(docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(frugal(signer(m)), SIGNATURE), "minhash-signatures")


def bucketed(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, hot): key, band, id, n and leader b of the buckets that two ids share at least; the heavy keys.  keys: id, band, key."""
    buckets = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("b")).filter("n > 1"), "minhash-buckets")
    total = buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = heavy_of(buckets, total)
    members = written(salted(keys, buckets, "key", hot).select("key", "band", "id", "n", "b"), "minhash-members")
    spent(buckets)
    return members, hot


def heavy_of(buckets: DataFrame, total: int) -> DataFrame:
    """The keys of buckets with over a thousandth of all entries: a thousand at most, so they pass through the driver."""
    n = buckets.filter(F.col("n") > max(1000, 0.001 * total)).select("key")
    return buckets.sparkSession.createDataFrame(n.collect() if total > 1000 else [], n.schema)


class Texts:
    """The texts of the documents that pairs need, fetched once each."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        self.parts: list[DataFrame] = []

    def of(self, ids: DataFrame) -> DataFrame:
        """id, text of at least these ids."""
        need = ids.distinct()
        for t in self.parts:
            need = need.join(t.select("id"), "id", "left_anti")
        need = written(need, "minhash-need")
        if not self.parts or not need.isEmpty():
            self.parts.append(written(self.docs.join(need, "id", "left_semi"), "minhash-texts"))
        spent(need)
        return reduce(DataFrame.unionByName, self.parts)


def near_links(docs: DataFrame, reps: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """a, b: links that connect whatever confirmed pairs connect.  reps: id, bands, packed of one document for each set."""
    members, hot = bucketed(reps.select("id", F.posexplode("bands").alias("band", "key")))
    packed = written(reps.select("id", "packed").join(members.select("id").distinct(), "id", "left_semi"), "minhash-packed")
    texts = Texts(docs)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """pairs a, b: those that are links."""
        crowd = heavy(pairs, "b")
        p = pairs.join(packed.select(F.col("id").alias("a"), F.col("packed").alias("pa")), "a")
        p = salted(p, packed.select(F.col("id").alias("b"), F.col("packed").alias("pb")), "b", crowd)
        p = p.filter(estimated(F.col("pa"), F.col("pb"), m) >= m.percent / 100 - m.margin).select("a", "b").distinct()
        likely = written(p, "minhash-likely")
        some = texts.of(likely.select(F.explode(F.array("a", "b")).alias("id")))
        p = likely.join(some.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        p = salted(p, some.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b", crowd)
        out = written(p.select("a", "b", "ta", "tb").mapInArrow(frugal(confirmer(m)), "a bigint, b bigint").distinct(), name)
        spent(likely)
        return out

    def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs with la and lb, the labels of a and b (themselves if they have none)."""
        top = heavy(pairs, "b")
        p = pairs.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a", "left")
        p = salted(p, labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b", top, "left")
        return p.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))

    def joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """id, label of the components that the labels and the links give: only components that links join are spread anew."""
        if labels is None:
            return components(links)
        over = written(labelled(links, labels).filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "minhash-over")
        new = components(over).select(F.col("id").alias("label"), F.col("label").alias("to"))
        every = labels.unionByName(new.select(F.col("label").alias("id"), "label")).groupBy("id").agg(F.min("label").alias("label"))
        every = written(every, "minhash-every")
        out = written(salted(every, new, "label", heavy(every, "label"), "left").select("id", F.coalesce("to", "label").alias("label")), "minhash-labels")
        spent(over, every)
        return out

    #: The pairs held against each other so far: the longer bands meet many of them again.
    done: list[DataFrame] = []

    def fresh_of(pairs: DataFrame) -> DataFrame:
        """The pairs not yet held against each other."""
        pairs = pairs.distinct()
        return pairs.join(reduce(DataFrame.unionByName, done), ["a", "b"], "left_anti") if done else pairs

    def connected(members: DataFrame, hot: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """(labels, large): the components that leaders and small buckets give; key, id, label, lead of the large buckets still open.

        The leaders of the first bands connect most; the other bands only hold apart what isn't connected by then.
        """
        for name, cond in (("minhash-first", F.col("band") < m.first), ("minhash-rest", F.col("band") >= m.first)):
            some = members.filter(cond)
            if labels is None:
                pairs = some.filter(F.col("id") != F.col("b")).select(F.col("id").alias("a"), "b")
            else:  # of each bucket only those that its leader isn't connected with
                mine = written(some.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label")), "minhash-mine")
                split = mine.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("id", "label")).alias("lead")).filter("low <> high")
                pairs = salted(mine, split.select("key", F.col("lead.id").alias("b"), F.col("lead.label").alias("lb")), "key", hot).filter("label <> lb").select(F.col("id").alias("a"), "b")
            pairs = written(fresh_of(pairs), name)
            done.append(pairs)
            labels = joined(labels, confirmed(pairs, "minhash-links"))
        now = members.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
        now = written(now, "minhash-now")
        open_ = now.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.min("id").alias("lead")).filter("low <> high")
        left = written(salted(now, open_.select("key", "n", "lead"), "key", hot), "minhash-left")
        small, large = left.filter(F.col("n") <= m.small), left.filter(F.col("n") > m.small)
        # The leader was held against all of its bucket.
        x, y = small.select("key", F.col("id").alias("a"), F.col("label").alias("la")), small.filter("id <> lead").select("key", F.col("id").alias("b"), F.col("label").alias("lb"))
        fresh = x.join(y, "key").filter((F.col("la") != F.col("lb")) & (F.col("a") > F.col("b"))).select("a", "b")
        fresh = written(fresh_of(fresh), "minhash-fresh")
        done.append(fresh)
        labels = joined(labels, confirmed(fresh, "minhash-more"))
        spent(now)
        return labels, large

    labels, large = connected(members, hot, None)
    spent(members)
    links = []
    if not large.isEmpty():
        far = replace(m, bands=m.long_bands, rows=m.long_rows)
        crowd = written(large.select("id").distinct().join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label")), "minhash-crowd")
        some = texts.of(crowd.select("id"))
        again = some.join(crowd.select("id"), "id", "left_semi").select("id", "text").mapInArrow(frugal(signer(far)), SIGNATURE)
        again = written(again.select("id", F.posexplode("bands").alias("band", "key")), "minhash-long")
        found, hot = bucketed(again)
        # Buckets within one component are settled; labels are needed only where a bucket is shared.
        split = found.join(crowd, "id").groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        members = written(salted(found, split.select("key"), "key", hot), "minhash-split")
        spent(again, found)
        labels, large = connected(members, hot, labels)
        if not large.isEmpty():
            links = [block_links(large, texts.of(large.select("id")), m)]
        spent(crowd, members)
    spent(packed, *texts.parts, *done)
    return reduce(DataFrame.unionByName, links, labels.filter("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b")))


def block_links(large: DataFrame, texts: DataFrame, m: MinHash) -> DataFrame:
    """The exact way for buckets of the longer bands that are large and still open: block against block, inside tasks.

    Large buckets that share a document are one crowd, so that a document is in one crowd only.  Its
    members outside the crowd's largest component are queries, held against all members; only
    links leave a task, one for each query and component.
    """
    crowds = components(large.filter("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b")))
    found = large.select("id", "label").distinct().join(crowds.withColumnRenamed("label", "crowd"), "id")
    sizes = found.groupBy("crowd", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("crowd").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
    main = main.withColumn("nq", F.ceil((F.col("n") - F.col("most")) / m.block)).withColumn("nt", F.ceil(F.col("n") / m.block)).filter("nq > 0")
    d = found.join(main, "crowd").join(texts.dropDuplicates(["id"]), "id")
    row = lambda q: [F.col("crowd"), F.col("i"), F.col("j"), F.lit(q).alias("query"), "id", "label", "text"]
    at = lambda k: F.pmod(F.xxhash64("id"), F.col(k))
    queries = d.filter("label <> main").withColumn("i", at("nq")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nt") - 1))).select(*row(True))
    against = d.withColumn("j", at("nt")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nq") - 1))).select(*row(False))

    def compare(part: pa.Table) -> pa.Table:
        words = Words()
        sets = [shingles(t.as_py(), m.shingle, words) for t in part.column("text").cast(pa.large_binary())]
        query = np.array(part.column("query").to_pylist(), bool)
        ids, label = part.column("id").to_numpy(), part.column("label").to_numpy()
        rest = np.flatnonzero(~query)
        size = np.array([len(sets[i]) for i in rest])
        tokens = np.concatenate([sets[i] for i in rest]) if len(rest) else np.empty(0, U)
        owner = np.repeat(np.arange(len(rest)), size)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        a, b = [], []
        for q in np.flatnonzero(query):
            lo, hi = np.searchsorted(tokens, sets[q], "left"), np.searchsorted(tokens, sets[q], "right")
            where = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
            both = np.bincount(owner[where], minlength=len(rest))
            good = np.flatnonzero((100 * both >= m.percent * (size + len(sets[q]) - both)) & (both > 0) & (label[rest] != label[q]))
            for k in good[np.unique(label[rest][good], return_index=True)[1]]:
                a.append(max(ids[q], ids[rest[k]]))
                b.append(min(ids[q], ids[rest[k]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    both = queries.unionByName(against)
    return written(both.groupBy("crowd", "i", "j").applyInArrow(compare, "a bigint, b bigint"), "minhash-block-links")


def grouped(docs: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """id, n_shingles, component_id, kept: one row for each row of docs.

    Null and empty texts, and those of white space alone, have no shingles and are linked with
    nothing.  Rows with the same doc_id are one document with the links of each of them; one with a null doc_id is linked with
    nothing and kept, its component null.  An empty table gives no rows.  Columns beside doc_id and
    text are not read.
    """
    sig = signed(docs, m)
    some = sig.filter("n_shingles > 0 AND id IS NOT NULL").withColumn("set", F.struct("set_a", "set_b", "n_shingles"))
    classes = some.groupBy("set").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = written(classes, "minhash-classes")
    reps = written(some.join(classes.select("set", F.col("rep").alias("id")), ["set", "id"], "left_semi").select("id", "bands", "packed"), "minhash-reps")
    links = near_links(docs, reps, m)
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    crowd = classes.filter(F.col("n") > max(1000, 0.001 * total)).select("set")
    mine = salted(some.select("id", "n_shingles", "set"), classes.select("set", "rep"), "set", crowd).select("id", "n_shingles", "rep")
    mine = written(mine, "minhash-mine")
    # A doc_id whose rows have several sets ties these together.
    ties = mine.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select(F.col("high").alias("a"), F.col("low").alias("b"))
    labels = components(links.unionByName(ties))
    spent(reps)
    top = heavy(mine, "rep")
    out = salted(mine, labels.select(F.col("id").alias("rep"), "label"), "rep", top, "left")
    out = out.select("id", "n_shingles", F.coalesce("label", "rep").alias("component_id"))
    rest = sig.filter("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """The documents with only the first of each group of near duplicates, one row each.

    Of rows that share a doc_id the one with the least text stays (nulls first), and of equal texts
    any: they differ in other columns at most.  Rows without an id stay, all of them.
    """
    gone = written(grouped(docs, m).filter("NOT kept").select("id").distinct(), "minhash-gone")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    d = d.join(gone, F.col("row.doc_id").cast("long") == F.col("id"), "left_anti")
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("k"))
    ids = written(ids, "minhash-repeated")
    if not ids.isEmpty():
        again = d.join(ids, F.col("row.doc_id") == F.col("k"))
        first = again.groupBy("k").agg(F.min_by("row", F.struct(F.col("row.text").isNotNull(), "row.text")).alias("row")).select("row")
        d = d.join(ids, F.col("row.doc_id") == F.col("k"), "left_anti").unionByName(first)
    return d.select("row.*")
