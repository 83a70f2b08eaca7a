"""Quality rules by distribution divergence.

A document's histograms of character classes and of common words are held against the reference
of its language (the sums over all documents of that language) by Jensen-Shannon distance.  Short
documents are guarded: below a minimum length a histogram says too little to reject a text.
Fixed base rules (too few words, too much repetition) come first.

The texts are scanned once, for expressions on the row alone; what they give is written, summed by
language (a few rows), and joined with those sums.  No text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bind, written

#: Character classes that are counted after a-z and white space; the rest of a text is a last class.
CLASSES = (
    ("upper", r"[A-Z]"),
    ("digit", r"[0-9]"),
    ("stop", r"[.,;:!?'\x22()-]"),
    ("symbol", r"[\x23\x24%&*+/<=>@\x5B-\x60{|}~]"),
)

#: Common words of English, German, French and Spanish.
COMMON = (
    "a and are as at be by for from in is it of on or that the to was with "
    "auf das dem der des die ein eine für ist mit nicht sich und von zu "
    "au aux de des du en est et la le les pour que qui sur un "
    "con del el las los no por se una y"
).split()
WORDS = tuple(dict.fromkeys(COMMON))


@dataclass(frozen=True)
class Rules:
    """Thresholds of the verdict."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: Guards: fewer characters or words than this are not judged by that histogram.
    min_chars: int = 100
    min_hist_words: int = 50
    max_class_distance: float = 0.30
    max_word_distance: float = 0.50
    #: A language with fewer words than this has no reference of its own.
    min_reference_words: int = 1000


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; none if it is null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def runs(words: Column) -> Column:
    """[(word, times)] of the common words among the words, as array<struct<w, n>>."""
    common = F.array_sort(F.filter(words, lambda w: w.isin(*WORDS)))

    def counted(s: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: ~s[i - 1].eqNullSafe(F.get(s, i)))
        return bind(ends, lambda e: F.transform(e, lambda x, k: F.struct(s[x - 1].alias("w"), (x - F.coalesce(F.get(e, k - 1), F.lit(0))).cast("long").alias("n"))))

    none = F.array().cast("array<struct<w:string,n:bigint>>")
    return bind(common, lambda s: F.when(F.size(s) > 0, counted(s)).otherwise(none))


def joined_windows(df: DataFrame, words: str, width: int) -> DataFrame:
    """df with __win: the hash of each window of `width` words (a power of two), by joining neighbours' hashes again and again."""
    df = df.withColumn("__win", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    step = 1
    while step < width:
        if 2 * step > width:
            raise ValueError("the window's width must be a power of two")
        n = F.size("__win") - step
        pairs = F.zip_with("__win", F.slice("__win", F.lit(step + 1), F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        df = df.withColumn("__next", F.when(n > 0, pairs)).withColumn("__win", F.when(F.col("__next").isNotNull(), F.slice("__next", F.lit(1), n)).otherwise(F.array().cast("array<bigint>"))).drop("__next")
        step *= 2
    return df


def covered(windows: Column, width: int) -> Column:
    """Words inside the windows that stand in the array twice or more."""
    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, same), lambda x: x["i"]))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda a, i: F.struct((a["n"] + (i + width - F.greatest(a["end"], i))).cast("long").alias("n"), (i + width).cast("int").alias("end"))
    return F.aggregate(bind(ranked, positions), start, step)["n"]


def half_terms(x: Column, y: Column) -> Column:
    """A bin's part of the Jensen-Shannon divergence, for its shares x and y."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    return (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2


def class_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if one is empty."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x.cast("double"))
    div = lambda tp, tq: F.aggregate(F.zip_with(p, q, lambda x, y: half_terms(x / tp, y / tq)), F.lit(0.0), lambda a, x: a + x)
    return bind(F.struct(total(p).alias("p"), total(q).alias("q")), lambda t: F.when((t["p"] > 0) & (t["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), div(t["p"], t["q"])))))


def word_distance(own: Column, n: Column, reference: Column, total: Column) -> Column:
    """The same of common words' counts, those of the document as [(word, times)], the reference's as a map; the rest of the words is one bin.

    A word of the reference alone adds half its share, so only the document's own words are looked up.
    """
    shares = F.transform(own, lambda r: F.struct((r["n"] / n).alias("x"), (F.coalesce(F.try_element_at(reference, r["w"]), F.lit(0).cast("long")) / total).alias("y")))

    def summed(s: Column) -> Column:
        add = lambda a, r: F.struct((a["d"] + half_terms(r["x"], r["y"])).alias("d"), (a["x"] + r["x"]).alias("x"), (a["y"] + r["y"]).alias("y"))
        return F.aggregate(s, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), add)

    common = F.aggregate(F.map_values(reference), F.lit(0.0), lambda a, x: a + x) / total
    rest = lambda t: t["d"] + half_terms(1 - t["x"], 1 - common) + (common - t["y"]) / 2
    return F.when((n > 0) & (total > 0), bind(bind(shares, summed), lambda t: F.sqrt(F.greatest(F.lit(0.0), rest(t)))))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def features(docs: DataFrame, carry: list[str], rules: Rules = Rules()) -> DataFrame:
    """`row` (the carried columns), lang, the measures, `classes` and `common`, written: the texts are scanned once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("lang").cast("string").alias("lang"), text.alias("__text"))
    d = d.withColumn("__words", words_of(F.col("__text")))
    d = d.withColumn("__bare", F.regexp_replace("__text", "[a-z]+", "")).withColumn("__dense", F.regexp_replace("__bare", f"[{SPACE}]+", ""))
    d = joined_windows(d, "__words", rules.window)
    d = d.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    count = lambda p: F.regexp_count("__dense", F.lit(p)).cast("long")
    size = lambda c: F.char_length(c).cast("long")
    d = d.withColumn("__dup", F.size(F.array_distinct("__win")) < F.size("__win"))
    d = d.withColumn("__counted", F.array(size("__text") - size("__bare"), size("__bare") - size("__dense"), *[count(p) for _, p in CLASSES]))
    d = d.select(
        "row",
        "lang",
        F.size("__words").cast("long").alias("n_words"),
        (size("__text") - size("__bare") + size("__dense")).alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__dup"), covered(F.col("__win"), rules.window)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array(*[F.col("__counted")[i] for i in range(len(CLASSES) + 2)], size("__dense") - sum([F.col("__counted")[i + 2] for i in range(len(CLASSES))], F.lit(0))).alias("classes"),
        runs(F.col("__words")).alias("common"),
        size("__text").alias("__n"),
    )
    return written(d.withColumnRenamed("__n", "n_chars"), "quality-features")


def references(found: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, classes, common (a map), total: summed over the documents of each language with enough words; lang null: over all documents."""
    n = len(CLASSES) + 3
    by = found.groupBy("lang").agg(F.sum("n_words").alias("total"), *[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n)])
    words = found.select("lang", F.explode("common").alias("r")).groupBy("lang", "r.w").agg(F.sum("r.n").alias("n"))
    words = words.groupBy("lang").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("w", "n")))).alias("common"))  # at most as many as WORDS
    every = found.agg(F.sum("n_words").alias("total"), *[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n)]).select(F.lit(None).cast("string").alias("lang"), "*")
    every_words = found.select(F.explode("common").alias("r")).groupBy("r.w").agg(F.sum("r.n").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("w", "n")))).alias("common"))
    own = by.filter(F.col("lang").isNotNull() & (F.col("total") >= rules.min_reference_words)).join(words, "lang", "left")
    both = own.unionByName(every.crossJoin(every_words))  # one row each
    none = F.create_map().cast("map<string,bigint>")
    return written(both.select("lang", F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.coalesce("common", none).alias("common"), F.array(*[F.coalesce(f"c{i}", F.lit(0).cast("long")) for i in range(n)]).alias("classes")), "quality-references")


def measured(docs: DataFrame, carry: list[str] | None = None, rules: Rules = Rules()) -> DataFrame:
    """`row` (the carried columns, all by default), the measures, distances and verdict.

    Null and empty texts have no words and fail the base rules.  A document whose language is null
    or has no reference is held against the sums of all documents.  Repeated rows are judged alike,
    each on its own.  Columns beside text and lang pass through in `row` whatever their names.
    """
    found = features(docs, docs.columns if carry is None else carry, rules)
    refs = references(found, rules)
    pack = F.struct("classes", "common", "total")
    own = refs.filter("lang IS NOT NULL").select(F.col("lang").alias("__lang"), pack.alias("__own"))
    every = refs.filter("lang IS NULL").select(pack.alias("__all"))
    d = found.join(own, F.col("lang") == F.col("__lang"), "left").crossJoin(F.broadcast(every))  # one row
    d = d.withColumn("__ref", F.coalesce("__own", "__all"))
    d = d.withColumn("class_distance", F.when(F.col("n_chars") >= rules.min_chars, F.round(class_distance(F.col("classes"), F.col("__ref.classes")), 6)))
    d = d.withColumn("word_distance", F.when(F.col("n_words") >= rules.min_hist_words, F.round(word_distance(F.col("common"), F.col("n_words"), F.col("__ref.common"), F.col("__ref.total")), 6)))
    d = d.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    far = (F.coalesce("class_distance", F.lit(0.0)) > rules.max_class_distance) | (F.coalesce("word_distance", F.lit(0.0)) > rules.max_word_distance)
    d = d.withColumn("kept", ~F.col("base_failed") & ~far)
    return d.select("row", *MEASURES, "class_distance", "word_distance", "base_failed", "kept")


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return measured(docs, None, rules).filter("kept").select("row.*")
