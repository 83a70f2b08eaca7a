"""Document quality by hierarchical empirical Bayes.

A document's own evidence is a naive Bayes log odds over binned features, learned from labelled
rows by grouped aggregation.  Hosts and the paths below them have rates of good documents, from
labels and, with less weight, from the documents' own probabilities; a host's rate shrinks toward
the global prior and a path's toward its host's, by strengths that the moments of the rates across
sites give.  The posterior joins a path's odds with the document's evidence.

Here a document's host is its source and the path its language section, as in the pages' URLs.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, held_out, written


@dataclass(frozen=True)
class Bayes:
    #: Added to a bin's counts of each class.
    smooth: float = 1.0
    #: What a document without a label counts in its site's rate.
    soft: float = 0.25
    #: Bounds of the shrinking strengths, in documents.
    least: float = 5.0
    most: float = 1000.0
    #: The odds of sites move a posterior by this factor at most.
    site_bound: float = 3.0
    #: Features are correlated: their summed evidence is damped.
    damping: float = 0.8
    threshold: float = 0.5


FEATURES = ("symbols", "bars", "uppers", "stops", "length", "word_length", "line_repeats")


def binned(text: Column) -> Column:
    """array<int>: the bin of each of FEATURES.  Parts are binned by thirds of an order of magnitude."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.char_length(t), F.lit(1)).cast("double")
    part = lambda x: F.when(x <= 0, F.lit(-20)).otherwise(F.greatest(F.lit(-12), F.floor(F.log10(x) * 3))).cast("int")
    count = lambda p: F.regexp_count(t, F.lit(p)) / chars
    dense = F.char_length(F.regexp_replace(t, f"[{SPACE}]+", "")).cast("double")
    n_words = F.greatest(F.regexp_count(t, F.lit(f"[{SPACE}]+")) + 1, F.lit(1))
    lines = F.filter(F.split(t, "\n"), lambda x: F.char_length(x) > 0)
    repeats = 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)).cast("double")
    return F.array(
        part(count(r"[#*$%&<>@=+~^_{}\\]")),
        part(count(r"\|")),
        part(count(r"\p{Lu}")),
        part(count(r"[.!?,;:]")),
        F.floor(F.log2(F.char_length(t) + 1)).cast("int"),
        F.least(F.lit(20), F.round(dense / n_words)).cast("int"),
        F.floor(repeats * 5).cast("int"),
    )


def log_odds(p: Column) -> Column:
    return F.ln(p / (1 - p))


def strength(sites: DataFrame, n: str, rate: str, center: Column, b: Bayes) -> Column:
    """The prior strength that matches the variance of sites' rates beyond chance, as an aggregate."""
    mean = F.sum(F.col(n) * center) / F.sum(n)
    chance = mean * (1 - mean)
    spread = F.sum(F.col(n) * F.pow(F.col(rate) - center, 2)) / F.sum(n)
    sampling = chance * F.count("*") / F.sum(n)
    between = F.greatest(spread - sampling, F.lit(1e-6))
    return F.coalesce(F.greatest(F.lit(b.least), F.least(F.lit(b.most), chance / between - 1)), F.lit(b.most))


def classified(docs: DataFrame, labels: DataFrame, b: Bayes = Bayes()) -> DataFrame:
    """id, held_out, evidence (log odds of the document alone), host_rate, path_rate, score, kept.

    Null and empty texts are binned like any; null hosts and paths are sites of their own.  Held-out
    rows give no labels but, like all unlabelled rows, soft counts.  Without labels the prior is
    one half and no evidence counts.  A document's site is judged by the others there, not by itself.  Labels that repeat a doc_id count by their smallest value;
    repeated documents score alike.  Other columns are not read.
    """
    quality = labels.select(F.col("doc_id").alias("k"), F.col("quality").cast("int").alias("q")).filter("q IS NOT NULL AND k IS NOT NULL").groupBy("k").agg(F.min("q").alias("q"))
    quality = quality.filter(~held_out(F.col("k")))
    d = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"), binned(F.col("text")).alias("bins"))
    d = written(d.join(quality, F.col("id") == F.col("k"), "left").drop("k"), "quality-bins")
    known = d.filter("q IS NOT NULL")
    totals = known.agg(F.sum("q").alias("good"), F.count("*").alias("n")).first()
    good, n = totals["good"] or 0, totals["n"]
    prior = (good + b.smooth) / (n + 2 * b.smooth)
    bins = known.select("q", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin").agg(F.sum("q").alias("g"), F.count("*").alias("m"))
    # A few bins for each feature, so they are collected and become expressions.
    odds = {(r["f"], r["bin"]): ((r["g"] + b.smooth) / (good + 2 * b.smooth), (r["m"] - r["g"] + b.smooth) / (n - good + 2 * b.smooth)) for r in bins.collect()}

    table = F.create_map(*[F.lit(x) for (f, v), (p, q) in sorted(odds.items()) for x in (f"{f}:{v}", round(log(p / q), 9))]) if odds else F.create_map().cast("map<string,double>")
    each = F.transform("bins", lambda v, i: F.coalesce(F.try_element_at(table, F.concat_ws(":", i, v)), F.lit(0.0)))
    evidence = F.lit(b.damping) * F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
    d = d.withColumn("evidence", evidence)
    d = d.withColumn("own", 1 / (1 + F.exp(-(F.col("evidence") + F.lit(log(prior / (1 - prior)))))))
    d = d.withColumn("w", F.when(F.col("q").isNull(), F.lit(b.soft)).otherwise(F.lit(1.0))).withColumn("y", F.coalesce(F.col("q").cast("double"), F.col("own")))
    d = written(d.select("id", "host", "path", "evidence", "w", "y"), "quality-evidence")  # no texts from here on
    paths = d.groupBy("host", "path").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("g"))
    paths = written(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("g").alias("hg"))
    hosts = hosts.withColumn("r", F.col("hg") / F.col("hn"))
    every = hosts.agg((F.sum("hg") / F.sum("hn")).alias("p")).first()["p"]
    every = prior if every is None else min(max(every, 1e-6), 1 - 1e-6)
    k_host = hosts.agg(strength(hosts, "hn", "r", F.lit(every), b).alias("k")).first()["k"]
    hosts = hosts.select(F.col("host").alias("h"), "hg", "hn", ((F.col("hg") + k_host * every) / (F.col("hn") + k_host)).alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).withColumn("pr", F.col("g") / F.col("n"))
    k_path = both.agg(strength(both, "n", "pr", F.col("host_rate"), b).alias("k")).first()["k"]
    both = written(both.select(F.col("host").alias("h"), F.col("path").alias("p"), "hg", "hn", "g", "n"), "quality-sites")
    # Sites are pre-aggregated; the documents' side may be skewed and AQE splits it.
    d = d.join(both, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    # A document's own count is taken out of its site's, or its evidence would count twice.
    own = F.col("w") * F.col("y")
    d = d.withColumn("host_rate", (F.col("hg") - own + k_host * every) / (F.col("hn") - F.col("w") + k_host))
    d = d.withColumn("path_rate", (F.col("g") - own + k_path * F.col("host_rate")) / (F.col("n") - F.col("w") + k_path))
    clipped = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_rate")))
    shift = F.greatest(F.lit(-log(b.site_bound)), F.least(F.lit(log(b.site_bound)), log_odds(clipped) - F.lit(log(every / (1 - every)))))
    d = d.withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + F.lit(log(prior / (1 - prior))) + shift))))
    return d.select("id", held_out(F.col("id")).alias("held_out"), F.round("evidence", 6).alias("evidence"), F.round("host_rate", 6).alias("host_rate"), F.round("path_rate", 6).alias("path_rate"), F.round("score", 6).alias("score"), (F.col("score") >= b.threshold).alias("kept"))
