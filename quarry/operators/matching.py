"""Joins and set operations: reconciliation, differences, containment, trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(expected: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that were expected and not found."""
    return expected.select(*on).distinct().join(found.select(*on), list(on), "left_anti")


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side alone, with the side they are on: empty if the sets are equal."""
    return left.exceptAll(right).distinct().join(right, left.columns, "left_anti").withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).distinct().join(left, left.columns, "left_anti").withColumn("side", F.lit("right")))


def multiset_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many more of each key the left has; keys with none are left out."""
    a = left.groupBy(*key).agg(F.count("*").alias("__a"))
    b = right.groupBy(*key).agg(F.count("*").alias("__b"))
    return a.join(b, list(key), "left").withColumn("missing", F.greatest(F.col("__a") - F.coalesce("__b", F.lit(0)), F.lit(0))).filter("missing > 0").select(*key, "missing")


def reconciled(left: DataFrame, right: DataFrame, key: str, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """key, issue: rows missing on a side, and checks whose two values differ (nulls equal each other)."""
    a, b = left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True))
    d = a.join(b, key, "full_outer")
    both = F.col("__l") & F.col("__r")
    kinds = [F.when(F.col("__r").isNull(), "missing"), F.when(F.col("__l").isNull(), "unexpected")]
    kinds += [F.when(both & ~x.eqNullSafe(y), name) for name, (x, y) in checks.items()]
    return d.select(key, F.explode(F.array_compact(F.array(*kinds))).alias("issue"))


def changed(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, fields that differ, for keys on both sides."""
    b = after.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    d = before.join(b, key)
    return d.select(key, F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in fields])).alias("fields")).filter(F.size("fields") > 0)


def edge_changes(before: DataFrame, after: DataFrame, key: str, targets: str) -> DataFrame:
    """key, added, removed: targets of each source before and after."""
    d = before.select(key, F.col(targets).alias("__b")).join(after.select(key, F.col(targets).alias("__a")), key, "full_outer")
    none = F.array().cast("array<string>")
    b, a = F.coalesce("__b", none), F.coalesce("__a", none)
    return d.select(key, F.array_except(a, b).alias("added"), F.array_except(b, a).alias("removed"))


def target_files(edges: DataFrame, names: DataFrame) -> DataFrame:
    """src, files: the files of each source's targets in order, each once, without its own.

    edges: src, ord, dst; names: section, file.
    """
    d = edges.filter(~F.col("src").eqNullSafe(F.col("dst"))).join(names, edges["dst"] == names["section"])
    listed = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", "dst", "file"))), lambda x: x["file"]))
    return d.groupBy("src").agg(listed.alias("files"))


def ordered_distinct(df: DataFrame, by: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """The values of each key in order, each where it first stands."""
    return df.groupBy(*by).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])).alias(name))


def in_ranges(points: DataFrame, ranges: DataFrame, on: Sequence[str], at: str, low: str, high: str, width: float) -> DataFrame:
    """Points joined with the ranges that hold them (both ends included).

    Ranges are cut into cells of the width, so that the join is by equal cells and not over all pairs.
    """
    cells = ranges.withColumn("__cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    d = points.withColumn("__cell", F.floor(F.col(at) / width)).join(cells, [*on, "__cell"])
    return d.filter((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("__cell")


def outside_ranges(points: DataFrame, ranges: DataFrame, on: Sequence[str], at: str, low: str, high: str, width: float) -> DataFrame:
    """Points that no range holds."""
    cells = ranges.select(*on, F.col(low).alias("__low"), F.col(high).alias("__high"), F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))).alias("__cell"))
    p = points.withColumn("__cell", F.floor(F.col(at) / width))
    on_cell = [p[c] == cells[c] for c in [*on, "__cell"]]
    hit = (p[at] >= cells["__low"]) & (p[at] <= cells["__high"])
    cond = on_cell[0]
    for c in on_cell[1:]:
        cond = cond & c
    return p.join(cells, cond & hit, "left_anti").drop("__cell")


def outside_boxes(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines whose middle lies in no table of their page."""
    x, y = (lines["x0"] + lines["x1"]) / 2, (lines["y0"] + lines["y1"]) / 2
    inside = (x >= tables["x0"]) & (x <= tables["x1"]) & (y >= tables["y0"]) & (y <= tables["y1"])
    return lines.join(tables, (lines["doc_id"] == tables["doc_id"]) & (lines["page"] == tables["page"]) & inside, "left_anti")


def preorder(children: DataFrame, roots: DataFrame) -> DataFrame:
    """node, pos, depth of every node that the roots reach, in the order of a depth-first walk; cycles are left at once.

    children: parent, ord, child; roots: ord, node.  A node that is reached twice counts where it is first reached.
    """
    spark = children.sparkSession
    children.createOrReplaceTempView("__children")
    roots.createOrReplaceTempView("__roots")
    d = spark.sql("""
        WITH RECURSIVE walk(node, path, seen) AS (
          SELECT node, array(CAST(ord AS BIGINT)), array(node) FROM __roots
          UNION ALL
          SELECT c.child, concat(w.path, array(CAST(c.ord AS BIGINT))), concat(w.seen, array(c.child))
          FROM walk w JOIN __children c ON c.parent = w.node WHERE NOT array_contains(w.seen, c.child))
        SELECT node, min(path) AS path FROM walk GROUP BY node""")
    return d.select("node", F.size("path").alias("depth"), "path")


def homonyms(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """src, name, dst: of targets with one name those that share a view with the source; else those titled so; else all.

    edges: src, name, dst; sources: src, views; targets: dst, title, dst_views.
    """
    d = edges.join(sources, "src").join(targets, "dst")
    d = d.withColumn("__view", F.arrays_overlap("views", "dst_views")).withColumn("__title", F.col("title") == F.col("name"))
    by = d.groupBy("src", "name").agg(F.max("__view").alias("__any_view"), F.max("__title").alias("__any_title"))
    d = d.join(by, ["src", "name"])
    return d.filter(F.when(F.col("__any_view"), F.col("__view")).when(F.col("__any_title"), F.col("__title")).otherwise(F.lit(True))).select("src", "name", "dst")


def unique_prefixes(names: DataFrame) -> DataFrame:
    """prefix, section, name: beginnings of two words up to all but one that lead to one section only.

    names: name, section.
    """
    w = F.split("name", " ")
    lengths = F.when(F.size(w) > 2, F.sequence(F.lit(2), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
    d = names.withColumn("__w", w).withColumn("__n", F.explode(lengths)).select(F.array_join(F.slice("__w", F.lit(1), F.col("__n")), " ").alias("prefix"), "section", "name")
    return d.groupBy("prefix").agg(F.count_distinct("section").alias("__s"), F.min("section").alias("section"), F.min("name").alias("name")).filter("__s = 1").drop("__s")


def general_scopes(views: DataFrame, least: int = 3) -> DataFrame:
    """The most frequent views, all that tie, if they are frequent enough.  views: view."""
    n = views.groupBy("view").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.agg(F.max("n").alias("__m"))), F.col("n") == F.col("__m")).filter(F.col("n") >= least).select("view", "n")  # one row


def document_frequency(docs: DataFrame, found: Column) -> DataFrame:
    """term, df: in how many rows each term stands; partial sums go before the shuffle."""
    return docs.select(F.explode(F.array_distinct(found)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def inverse_frequency(df: Column, n: Column) -> Column:
    return F.ln((n + 1) / (df + 1)) + 1


def likely_terms(tf: DataFrame, frequency: DataFrame, rows: DataFrame, by: str, k: int, heavy: int = 50_000) -> DataFrame:
    """by, term, n: the rows of tf that can be among their key's k best by n times the inverse frequency, and some more.

    tf: by, term, n; frequency: term, df; rows: one row with the number of documents, `rows`. The terms with the most
    documents are broadcast, as many as `heavy` at most, and weighed; any other term's weight lies between those of df 1
    and of the bound. What stays below the k-th best lower bound of its key goes before anything is shuffled by term.
    """
    sums = F.broadcast(rows.crossJoin(frequency.agg(F.floor(F.sum("df") / heavy).alias("__cap"))))  # one row
    weight = lambda df: inverse_frequency(df, F.col("rows"))
    known = frequency.crossJoin(sums).filter(F.col("df") > F.greatest("__cap", F.lit(1))).select("term", weight(F.col("df")).alias("__w"))
    d = tf.join(F.broadcast(known), "term", "left").crossJoin(sums)
    low, high = (F.col("n") * F.coalesce("__w", weight(df)) for df in (F.greatest("__cap", F.lit(1)), F.lit(1)))
    best = Window.partitionBy(by).orderBy(F.desc("__low")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.select(by, "term", "n", low.alias("__low"), high.alias("__high")).withColumn("__least", F.nth_value("__low", k).over(best))
    return d.filter(F.col("__least").isNull() | (F.col("__high") >= F.col("__least") * (1 - 1e-9) - 1e-5)).select(by, "term", "n")  # scores may be rounded to 6 places


def report(commands: DataFrame) -> DataFrame:
    """One row of counts over commands."""
    filled = lambda c: F.count_if(F.col(c) != "")
    return commands.agg(
        F.count("*").alias("commands"),
        F.sum(F.size("clis")).alias("templates"),
        F.sum(F.size("parameters")).alias("parameters"),
        F.sum(F.size("examples")).alias("example_snippets"),
        filled("usage_guidelines").alias("commands_with_usage_guidelines"),
        filled("extra").alias("commands_with_extra_info"),
        F.count_if(F.size("related_topics") > 0).alias("commands_with_related_topics"),
        F.sum(F.size("related_topics")).alias("related_topics"),
    )
