"""Ordered operators: what a fold over rows would do, as window functions.

Every operator takes the columns that name the sequence and its order; none relies on the order in
which rows happen to arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def segments(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column, name: str = "segment") -> DataFrame:
    """Numbers the segments that rows with `starts` begin; rows before the first have 0."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*TO_HERE)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(w))


def filled(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """The latest value that isn't null, as of each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*TO_HERE)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def commands(events: DataFrame, heading: Column, label: Column) -> DataFrame:
    """Events with command_id (a heading begins one; those before the first go) and field (the latest label within it)."""
    found = segments(events, ["doc_id"], ["page", "ord"], heading, "command_id").filter("command_id > 0")
    return filled(found, ["doc_id", "command_id"], ["page", "ord"], label, "field")


def end_pages(events: DataFrame, page_count: int) -> DataFrame:
    """doc_id, command_id, start_page, end_page, truncated: the last command may go on if pages were left out."""
    by = events.groupBy("doc_id", "command_id").agg(F.min("page").alias("start_page"), F.max("page").alias("end_page"))
    last = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("command_id"))) == 1
    return by.withColumn("truncated", last & (F.col("end_page") < page_count))


def gap_groups(df: DataFrame, by: Sequence[str], order: Sequence[str], gap: Column, limit: float, name: str = "run") -> DataFrame:
    """Runs of rows whose gap to the row before is not above the limit, numbered from 1."""
    w = Window.partitionBy(*by).orderBy(*order)
    fresh = F.coalesce(gap > limit, F.lit(True)) | (F.row_number().over(w) == 1)
    return segments(df.withColumn("__fresh", fresh), by, order, F.col("__fresh"), name).drop("__fresh")


def span_runs(spans: DataFrame, gap: float = 8.0) -> DataFrame:
    """Spans of a line split where the blank between two is wider than the gap."""
    w = Window.partitionBy("doc_id", "page", "line").orderBy("x0")
    return gap_groups(spans.withColumn("__gap", F.col("x0") - F.lag("x1").over(w)), ["doc_id", "page", "line"], ["x0"], F.col("__gap"), gap).drop("__gap")


def paragraph_text(lines: DataFrame, by: Sequence[str], order: Sequence[str], leading: float = 4.0) -> DataFrame:
    """One text for each key: lines joined by a blank, by a line end after a gap on the same page, by nothing after a hyphen.

    Table rows come as lines of kind 'table' with their cells joined; a line end stands on both sides.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.lag(F.struct("kind", "page", "y1", "text")).over(w)
    line = F.when(F.col("kind") == "table", F.concat(F.lit("\n"), "text", F.lit("\n")))
    gap = before.isNull() | (before["kind"] == "table") | ((before["page"] == F.col("page")) & (F.col("y0") - before["y1"] > leading))
    sep = F.when(F.regexp_replace(F.coalesce(before["text"], F.lit("")), r"\s+$", "").endswith("-") & (before["kind"] == "line"), "").when(gap, "\n").otherwise(" ")
    piece = F.coalesce(line, F.concat(sep, F.regexp_replace("text", r"(?U)^\s+|\s+$", "")))
    pieces = lines.withColumn("__piece", piece).withColumn("__ord", F.row_number().over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__ord", "__piece"))), lambda x: x["__piece"]), "")
    return pieces.groupBy(*by).agg(F.regexp_replace(text, r"(?U)^\s+|\s+$", "").alias("text"))


def joined_lines(lines: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Plain lines joined: nothing after a hyphen, a line end after a full stop, else a blank."""
    w = Window.partitionBy(*by).orderBy(order)
    before = F.lag("line").over(w)
    sep = F.when(before.isNull() | before.endswith("-"), "").when(before.endswith("."), "\n").otherwise(" ")
    d = lines.withColumn("__piece", F.concat(sep, F.col("line")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "__piece"))), lambda x: x["__piece"]), "")
    return d.groupBy(*by).agg(text.alias("text"))


def leaves(outline: DataFrame, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Outline entries that no deeper entry follows."""
    nxt = F.lead("level").over(Window.partitionBy(*by).orderBy("idx"))
    return outline.withColumn("__next", nxt).filter("__next IS NULL OR __next <= level").drop("__next")


def page_ranges(outline: DataFrame, page_count: Column, by: Sequence[str] = ("doc_id",), levels: int = 9) -> DataFrame:
    """first_page and last_page of each entry: it ends on the page of the next entry that is no deeper, that page included.

    For each level one value carried from the last entry to the first, not a join of the outline with itself: a frame
    that ends with the partition would be read anew for each row.
    """
    after = Window.partitionBy(*by).orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.when(F.col("level") == n, F.last(F.when(F.col("level") <= n, F.col("page")), ignorenulls=True).over(after)) for n in range(1, levels + 1)]
    return outline.withColumn("first_page", F.col("page")).withColumn("last_page", F.coalesce(*ends, page_count))


def section_numbers(outline: DataFrame) -> DataFrame:
    """Dotted numbers from levels alone: each entry counts up at its level and starts the deeper ones anew."""
    step = lambda path, e: F.concat(F.slice(F.concat(path, F.array_repeat(F.lit(0), 32)), F.lit(1), e["level"] - 1), F.array(F.get(F.concat(path, F.array_repeat(F.lit(0), 32)), e["level"] - 1) + 1))
    start = F.struct(F.array().cast("array<int>").alias("path"), F.array().cast("array<struct<idx:int,section:string>>").alias("out"))

    def put(acc: Column, e: Column) -> Column:
        path = step(acc["path"], e)
        return F.struct(path.alias("path"), F.concat(acc["out"], F.array(F.struct(e["idx"].cast("int").alias("idx"), F.array_join(F.transform(path, lambda x: x.cast("string")), ".").alias("section")))).alias("out"))

    found = outline.groupBy("doc_id").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("idx", "level"))), start, put)["out"].alias("o"))
    found = found.select("doc_id", F.explode("o").alias("o")).select("doc_id", F.col("o.idx").alias("idx"), F.col("o.section").alias("section"))
    return outline.drop("section").join(found, ["doc_id", "idx"])


def continued_headings(headings: DataFrame) -> DataFrame:
    """Headings wrapped over lines: on the same page and less than 10 below the line before, a line goes on."""
    w = Window.partitionBy("doc_id").orderBy("page", "y0")
    gap = F.when(F.lag("page").over(w) == F.col("page"), F.col("y0") - F.lag("y1").over(w))
    d = headings.withColumn("__starts", ~F.coalesce((gap >= 0) & (gap < 10), F.lit(False)))
    d = segments(d, ["doc_id"], ["page", "y0"], F.col("__starts"), "__n")
    title = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "y0", "text"))), lambda x: x["text"]), " ")
    return d.groupBy("doc_id", "__n").agg(F.min("page").alias("page"), title.alias("title")).drop("__n")


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def first_of_each(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key."""
    return numbered(df, by, order, "__k").filter(F.col("__k") <= k).drop("__k")


def unique_best(df: DataFrame, by: Sequence[str], score: Column) -> DataFrame:
    """The best row of each key, none if two are best alike."""
    w = Window.partitionBy(*by)
    d = df.withColumn("__score", score)
    d = d.withColumn("__best", F.max("__score").over(w)).filter("__score = __best")
    return d.withColumn("__n", F.count("*").over(w)).filter("__n = 1").drop("__score", "__best", "__n")


def parameter_rows(rows: DataFrame) -> DataFrame:
    """doc_id, command_id, pos, name, info: rows without a name go on with the one before; so do those that repeat its name, after page 1."""
    by, order = ["doc_id", "command_id"], ["ord"]
    rows = rows.filter("name <> '' OR info <> ''").withColumn("__name", F.when(F.col("name") != "", F.col("name")))
    last = filled(rows, by, order, F.col("__name"), "__last")
    w = Window.partitionBy(*by).orderBy(*order)
    same = (F.col("name") == F.lag("__last").over(w)) & (F.col("page") > 1)
    d = segments(last.withColumn("__new", (F.col("name") != "") & ~F.coalesce(same, F.lit(False))), by, order, F.col("__new"), "pos")
    d = d.filter("pos > 0")
    info = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "info"))), lambda x: x["info"]), "\n")
    return d.groupBy(*by, "pos").agg(F.max("__last").alias("name"), info.alias("info"))
