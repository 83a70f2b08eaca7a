"""Page layout from positions: boxes, rules, rows between rules, side labels and reading order.

Spans or lines of a page are keyed by doc_id and page; joins are by page and range, and a page holds
no more than what is printed on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import filled, segments

PAGE = ["doc_id", "page"]
SIDE = 125.0


def enclosing_boxes(boxes: DataFrame, by: list[str]) -> DataFrame:
    """The smallest box around the boxes of each key."""
    return boxes.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def side_labels(lines: DataFrame, label: Column, left: float = SIDE) -> DataFrame:
    """Labels of fields in the side column."""
    return lines.filter((F.col("x0") < left) & label.isNotNull())


def rules(drawings: DataFrame) -> DataFrame:
    """doc_id, page, x0, x1, y: horizontal rules, drawn pieces of one height once; rounded to a tenth."""
    d = drawings.select(*PAGE, F.round("x0", 1).alias("x0"), F.round("x1", 1).alias("x1"), F.round((F.col("y0") + F.col("y1")) / 2, 1).alias("y"))
    return d.distinct()


def ruled_rows(found: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, page, x0, x1, top, bottom: the space between each two neighbouring rules of equal ends, but for those that hold a label."""
    w = Window.partitionBy(*PAGE, "x0", "x1").orderBy("y")
    rows = found.withColumn("bottom", F.lead("y").over(w)).filter("bottom IS NOT NULL").withColumnRenamed("y", "top")
    at = labels.select(*PAGE, ((F.col("y0") + F.col("y1")) / 2).alias("__at"))
    inside = [rows[c] == at[c] for c in PAGE] + [at["__at"] > rows["top"], at["__at"] < rows["bottom"]]
    return rows.join(at, inside, "left_anti")


def row_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines whose left edge and middle lie in each row, with the row's top and bottom."""
    r = rows.select(*[F.col(c).alias(f"r_{c}") for c in [*PAGE, "x0", "x1"]], "top", "bottom")
    middle = (lines["y0"] + lines["y1"]) / 2
    on = (lines["doc_id"] == r["r_doc_id"]) & (lines["page"] == r["r_page"]) & (middle > r["top"]) & (middle < r["bottom"]) & (lines["x0"] >= r["r_x0"]) & (lines["x0"] <= r["r_x1"])
    return lines.join(r, on).drop("r_doc_id", "r_page")


def column_boundaries(rows: DataFrame, right_edge: Column, label: Column) -> DataFrame:
    """Rows with `boundary`: a row's own second column, else that of a row above it since the last label."""
    by = [*PAGE, "x0", "x1"]
    d = segments(rows.withColumn("__label", label).withColumn("__edge", right_edge), by, ["top"], F.col("__label"), "__part")
    return filled(d, [*by, "__part"], ["top"], F.col("__edge"), "boundary").drop("__label", "__edge", "__part")


def reading_order(lines: DataFrame, left: float = SIDE, near: float = 4.0, same: float = 1.0) -> DataFrame:
    """doc_id, page, ord, x0, y0, x1, y1, text, spans: body lines moved to a side label within `near`, pieces of one line joined.

    Pieces whose height differs by less than `same` from the piece before are one line; a blank stands
    between two that are more than 0.8 apart.
    """
    w = Window.partitionBy(*PAGE)
    labels = lines.filter(F.col("x0") < left).select(*PAGE, F.col("y0").alias("__label"))
    body = lines.withColumn("__id", F.monotonically_increasing_id())
    gap = F.abs(F.col("y0") - F.col("__label"))
    snapped = body.filter(F.col("x0") >= left).join(labels, PAGE).filter(gap < near).groupBy("__id", *PAGE).agg(F.min_by("__label", gap).alias("__to"))
    d = body.join(snapped.drop(*PAGE), "__id", "left").withColumn("__y", F.coalesce("__to", "y0")).withColumn("__side", F.col("x0") < left)
    order = w.orderBy(F.round("__y", 1), F.desc("__side"), "x0", "__id")
    before = F.lag(F.struct("__y", "__side")).over(order)
    joins = F.coalesce(~F.col("__side") & ~before["__side"] & (F.abs(F.col("__y") - before["__y"]) < same), F.lit(False))
    d = d.withColumn("__new", ~joins).withColumn("ord", F.row_number().over(order))
    d = segments(d, PAGE, ["ord"], F.col("__new"), "__line")
    pieces = F.array_sort(F.collect_list(F.struct("x0", "ord", "x1", "text", "spans")))
    g = d.groupBy(*PAGE, "__line").agg(F.min("ord").alias("ord"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), pieces.alias("p"))
    start = F.struct(F.lit(None).cast("double").alias("x1"), F.lit("").alias("text"))
    text = F.aggregate("p", start, lambda a, p: F.struct(p["x1"].alias("x1"), F.concat(a["text"], F.when(p["x0"] - a["x1"] > 0.8, " ").otherwise(""), p["text"]).alias("text")))["text"]
    return g.select(*PAGE, F.row_number().over(w.orderBy("ord")).alias("ord"), "x0", "y0", "x1", "y1", text.alias("text"), F.flatten(F.transform("p", lambda x: x["spans"])).alias("spans"))


def footer_tops(lines: DataFrame, heights: DataFrame, pattern: str, part: float = 0.2) -> DataFrame:
    """doc_id, page, bottom: where the lowest part of a page has a line that fits the footer's pattern."""
    d = lines.join(heights.select(*PAGE, "height"), PAGE).filter((F.col("y0") > F.col("height") * (1 - part)) & F.col("text").rlike(pattern))
    return d.groupBy(*PAGE).agg(F.min("y0").alias("bottom"))
