"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate.  HyperLogLog sketches of the sites, one for each
line hash, are built and merged by aggregation; where the estimate is near the threshold the sites
are counted exactly.  Boilerplate goes from every document but the first that has it, so that the
corpus loses no line altogether.

Only lines seen on two sites at least can be boilerplate, so sketches are made for those alone.
Heavy lines are a bounded set by definition (a share of all occurrences each) and are salted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, salted, spent, written


@dataclass(frozen=True)
class Spread:
    min_sites: int = 10
    #: Lines of fewer words are never boilerplate: they recur by themselves.
    min_words: int = 3
    #: log2 of a sketch's registers.
    lg_k: int = 12
    #: Estimates within this part of the threshold, or within 1, are replaced by exact counts.
    near: float = 0.10
    #: A line is heavy from this part of all occurrences; there are 1 / heavy of them at most.
    heavy: float = 0.001


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, f"^[{SPACE}]+|[{SPACE}]+$", "")


def eligible(line: Column, min_words: int) -> Column:
    return line.rlike(f"^[{SPACE}]*([^{SPACE}]+[{SPACE}]+){{{min_words - 1}}}[^{SPACE}]")


def line_hash(line: Column) -> Column:
    return F.xxhash64(trimmed(line))


def occurrences(docs: DataFrame, s: Spread) -> DataFrame:
    """id, t, site, h, pos: each eligible line of each document; t is a hash of the text, so that id and t know a row."""
    text = F.col("text")
    each = F.transform(lines_of(text), lambda x, i: F.when(eligible(x, s.min_words), F.struct(line_hash(x).alias("h"), i.alias("pos"))))
    d = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("t"), F.col("source").cast("string").alias("site"), F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x"))
    return d.select("id", "t", "site", "x.*")


def boilerplate(docs: DataFrame, s: Spread = Spread()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines, found, hot): h, n_sites, first_id, first_t of the boilerplate lines; id, t, h, pos where shared lines stand; the heavy lines' h.

    The first is the least id that has the line, and only among rows without one the least t.
    """
    seen = written(occurrences(docs, s), "lines-seen")
    site = F.xxhash64("site")
    known = F.col("site").isNotNull()
    shared = seen.groupBy("h").agg(F.min(F.when(known, site)).alias("a"), F.max(F.when(known, site)).alias("b"), F.count("*").alias("n")).filter("a <> b").select("h", "n")
    shared = written(shared, "lines-shared")
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = shared.filter(F.col("n") > max(1000, s.heavy * total)).select("h")
    found = written(salted(seen, shared.select("h"), "h", hot), "lines-found")
    spent(seen)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", F.when(F.col("id").isNull(), F.col("t")).alias("t"))).alias("first")
    spread = found.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(s.lg_k)).alias("sketch"), first)
    spread = written(spread.select("h", F.col("first.id").alias("first_id"), F.col("first.t").alias("first_t"), F.hll_sketch_estimate("sketch").alias("n_sites")), "lines-spread")
    band = max(1.0, s.near * s.min_sites)
    near = F.abs(F.col("n_sites") - s.min_sites) <= band
    pairs = found.join(spread.filter(near).select("h"), "h", "left_semi").filter("site IS NOT NULL").groupBy("h", "site").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("h").agg(F.count("*").alias("n_sites"))
    exact = exact.join(spread.select("h", "first_id", "first_t"), "h").select("h", "first_id", "first_t", "n_sites")
    both = spread.filter(~near).select("h", "first_id", "first_t", "n_sites").unionByName(exact)
    lines = written(both.filter(F.col("n_sites") >= s.min_sites), "lines-boilerplate")
    spent(spread)
    return lines, found.select("id", "t", "h", "pos"), hot


def cleaned(docs: DataFrame, s: Spread = Spread()) -> DataFrame:
    """`row` (the document as it came), `clean` (its text without boilerplate), n_lines, n_removed.

    Lines are compared without white space at their ends.  A null text stays null, with no lines;
    an empty text has one empty line.  A null source counts as no site.  Rows that repeat lose the
    same lines; all rows of the first doc_id keep theirs.  A row without a doc_id is first only
    where no row with one has the line, and then by a hash of its text.  Columns beside doc_id,
    text and source pass through in `row` whatever their names; an empty table stays empty.
    """
    lines, found, hot = boilerplate(docs, s)
    first = F.col("first_id").eqNullSafe(F.col("id")) & (F.col("id").isNotNull() | (F.col("first_t") == F.col("t")))
    hits = salted(found, lines.select("h", "first_id", "first_t"), "h", hot).filter(~first)
    bad = hits.groupBy(F.col("id").alias("__id"), F.col("t").alias("__t")).agg(F.collect_set("pos").alias("bad"))  # no more than one document's lines
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    d = d.join(bad, F.col("row.doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("row.text") == F.col("__t")), "left").select("row", "bad")
    d = d.withColumn("all", lines_of(F.col("row.text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "bad")
    d = d.withColumn("kept", F.when(F.col("bad").isNotNull(), F.transform(left, lambda i: F.get(F.col("all"), i))))
    return d.select(
        "row",
        F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("row.text")).alias("clean"),
        F.when(F.col("all").isNull(), F.lit(0)).otherwise(F.size("all")).cast("long").alias("n_lines"),
        F.when(F.col("bad").isNull(), F.lit(0)).otherwise(F.size("bad")).cast("long").alias("n_removed"),
    )


def without_boilerplate(docs: DataFrame, s: Spread = Spread()) -> DataFrame:
    """The documents with the cleaned text (and n_chars, if they have it, to match); those of which no word is left go."""
    d = cleaned(docs, s)
    d = d.filter((F.col("n_removed") == 0) | F.col("clean").rlike(f"[^{SPACE}]"))
    put = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return d.select(*[(put[c] if c in put else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
