"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the sources, in code point order, take the weights in turn and share a budget of words; a
source is used a bounded number of times, and what exceeds that is shared anew.  Within a source
each document gets the exponential key -ln(u) / quality; complete epochs come first, then the
documents with the smallest keys up to the rest of the target.

Where a source's budget ends is searched over a narrow table without texts: its rows fall into bins
between the least and the greatest key, the bins are summed, and the bin in which the budget ends is
cut into bins again until few rows are left.  One row for each source tells the last document
taken, and one pass over the documents compares each with it.  No text is copied or shuffled and no
source's rows meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, spent, unit, written


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)
    #: The budget as a part of all words, and how often a source can be used.
    share: float = 1.5
    max_epochs: int = 2
    #: Bins of a source at each step, and the rows of a bin from which it is cut again.
    bins: int = 4096
    few: int = 10_000
    seed: int = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """A document's quality weight, 0.1 to 1: less for each part of its characters that is a symbol."""
    chars = F.greatest(F.char_length(text), F.lit(1))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * F.regexp_count(text, F.lit(r"[#*$%&|<>]")) / chars)


def holds_map(kind: T.DataType) -> bool:
    """Whether a type can't be hashed because there is a map in it."""
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and holds_map(kind.elementType)


def keyed(docs: DataFrame, m: Mix, *also: Column) -> DataFrame:
    """The columns in `also`, then source, size, key and same: the order of a source's rows is that of key, size, same.

    `same` is a hash of the whole row, so that only rows that agree in every column are ties.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A row without an id is known by its text.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(text.cast("binary"))))
    every = [F.to_json(F.struct(F.col(f"`{f.name}`").alias("x"))) if holds_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema.fields]
    return docs.select(
        *also,
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        (-F.ln(unit(F.lit(m.seed), name)) / quality(text)).alias("key"),
        F.pmod(F.xxhash64(*every), F.lit(2**52)).alias("same"),
    )


def targets(sizes: DataFrame, m: Mix = Mix()) -> DataFrame:
    """source, source_size, target: one row for each source (windows over the table of sources, not of documents)."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in m.weights])
    by = by.withColumn("weight", F.get(weights, (F.row_number().over(order) - 1) % len(m.weights)))
    by = by.withColumn("cap", F.col("source_size") * float(m.max_epochs))
    # Sources reach their caps in the order of cap / weight.  With those before it at their caps, a
    # source's level is what is left for each unit of the others' weight; the first that the level
    # doesn't fill sets it for all that follow.
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumn("level", (F.sum("source_size").over(every) * F.lit(m.share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    by = by.withColumn("open", F.col("cap") / F.col("weight") > F.col("level"))
    by = by.withColumn("common", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level").alias("level")))).over(every)["level"])
    target = F.when(F.col("common").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("common")))
    return by.select("source", "source_size", F.round(target, 6).alias("target"))


def cuts(sizes: DataFrame, m: Mix = Mix()) -> DataFrame:
    """For each source: s, source_size, target, epochs, and where its budget ends.

    `last` (key, size, same) is the first row that isn't wholly taken, or the last of all that are;
    of its `ties` rows `part` are taken.  Rows before it are taken, rows after it are not.  A
    source without words has no `last`.  Written.
    """
    goal = targets(sizes, m).select(F.col("source").alias("s"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = written(goal.withColumn("epochs", whole).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    own = F.col("source").eqNullSafe(F.col("s"))
    live, left = sizes.select("source", "key", "size", "same"), goal.select("s", F.col("rest").alias("left"))
    used = []
    while True:
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("key", "size", "same") for f in (F.min, F.max)]
        span = written(live.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n"), *ends), "mix-span")
        alike = F.lit(True)
        for c in ("key", "size", "same"):
            alike = alike & (F.col(f"min_{c}") == F.col(f"max_{c}"))
        done = span.filter((F.col("n") > m.few) & ~alike).isEmpty()
        if done:
            break
        at = F.lit(0.0)
        for c in ("same", "size", "key"):
            at = F.when(F.col(f"min_{c}") < F.col(f"max_{c}"), (F.col(c) - F.col(f"min_{c}")) / (F.col(f"max_{c}") - F.col(f"min_{c}"))).otherwise(at)
        dealt = live.join(span, own).withColumn("bin", F.least(F.lit(m.bins - 1), F.floor(at * m.bins)).cast("int"))
        bins = dealt.groupBy("source", "bin").agg(F.sum("size").alias("words"))
        up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.coalesce(F.sum("words").over(up_to), F.lit(0)).cast("long")).join(left, own)
        ending = bins.filter((F.col("before") <= F.col("left")) & (F.col("before") + F.col("words") > F.col("left")))
        ending = written(ending.select("s", F.col("bin").alias("b"), (F.col("left") - F.col("before")).alias("left")), "mix-ending")
        narrowed = dealt.join(ending.withColumnRenamed("s", "e"), F.col("source").eqNullSafe(F.col("e")) & (F.col("bin") == F.col("b")))
        narrowed = written(narrowed.select("source", "key", "size", "same"), "mix-live")
        spent(span, *used)
        live, left, used = narrowed, ending.select("s", "left"), [narrowed, ending]
    ties = live.groupBy("source", "key", "size", "same").agg(F.count("*").alias("ties"))
    so_far = Window.partitionBy("source").orderBy("key", "size", "same").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.join(left, own).withColumn("room", F.col("left") - F.coalesce(F.sum(F.col("size") * F.col("ties")).over(so_far), F.lit(0)))
    # A row is taken if the budget reaches its middle.
    part = F.when(F.col("size") == 0, F.when(F.col("room") >= 0, F.col("ties")).otherwise(0)).otherwise(F.floor(F.col("room") / F.col("size") + 0.5))
    ties = ties.withColumn("part", F.greatest(F.lit(0), F.least(F.col("ties"), part)).cast("long"))
    row = F.struct(F.struct("key", "size", "same").alias("last"), "ties", "part")
    found = ties.groupBy("source").agg(F.coalesce(F.min(F.when(F.col("part") < F.col("ties"), row)), F.max(row)).alias("end"))
    out = goal.drop("rest").join(found, F.col("s").eqNullSafe(F.col("source")), "left").select("s", "source_size", "target", "epochs", "end.*")
    out = written(out, "mix-cuts")
    spent(goal, span, *used)
    return out


def dealt_out(rows: DataFrame, ends: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, source, size, source_size, target, copies; rows: the carried columns and those of `keyed`.

    One pass, with the table of sources joined (its written size is known, so Spark broadcasts it if it is small).
    """
    d = rows.join(ends, F.col("source").eqNullSafe(F.col("s")))
    mine = F.struct("key", "size", "same")
    copies = F.col("epochs") + F.when(mine < F.col("last"), 1).when((mine == F.col("last")) & (F.col("part") == F.col("ties")), 1).otherwise(0)
    out = [*carried, "source", "size", "source_size", "target"]
    split = (F.col("part") > 0) & (F.col("part") < F.col("ties"))
    if ends.filter(split).isEmpty():
        return d.select(*out, copies.cast("long").alias("copies"))
    # Rows that agree in every column and of which the budget takes only some: one of them stands for all.
    split = F.coalesce(split & (mine == F.col("last")), F.lit(False))
    one = d.filter(split).groupBy("source").agg(F.first(F.struct(*[F.col(c) for c in out], "epochs", "part", "ties")).alias("x")).select("x.*")
    block = F.lit(100_000)
    one = one.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ties") - 1, block.cast("long"))))
    one = one.withColumn("i", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + block, F.col("ties")) - 1)))
    one = one.select(*out, (F.col("epochs") + (F.col("i") < F.col("part")).cast("long")).alias("copies"))
    return d.filter(~split).select(*out, copies.cast("long").alias("copies")).unionByName(one)


def mixed(docs: DataFrame, m: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row for each row of docs.

    A null or empty text has size 0 and is never taken.  Documents of equal keys (a doc_id that
    repeats) are ordered by size, then by a hash of all their columns; of rows that agree in all
    of them as many are taken as the budget reaches.  Rows without a doc_id take their key from the
    text.  Null sources form one source, the last.  The last document to be taken is the one whose
    middle the budget reaches.  Keys depend on seed and rows alone, so reruns agree.  An empty
    table gives no rows; other columns count in the hash alone.
    """
    rows = written(keyed(docs, m, F.col("doc_id")), "mix-sizes")
    d = dealt_out(rows, cuts(rows, m), ["doc_id"])
    return d.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, m: Mix = Mix()) -> DataFrame:
    """The mix itself: the documents' columns and `copies`, how often each goes in; those that don't are left out.

    Rows are treated as in `mixed`; the column is called copies_ where the documents have one of that name.
    """
    name = "copies"
    while name in docs.columns:
        name += "_"
    sizes = written(keyed(docs, m), "mix-sizes")
    ends = cuts(sizes, m)
    spent(sizes)
    rows = keyed(docs, m, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    d = dealt_out(rows, ends, ["row"]).filter((F.col("copies") > 0) & (F.col("size") > 0))
    return d.select("row.*", F.col("copies").cast("int").alias(name))
