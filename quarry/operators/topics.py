"""Parameter topics: which command describes what a parameter names, by TF-IDF overlap of descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .matching import document_frequency, inverse_frequency

FLOOR = 0.15


def first_line(c: Column) -> Column:
    return F.split(c, "\n")[0]


def bare(title: Column) -> Column:
    return F.regexp_replace(title, r"\s*\([^)]*\)$", "")


def vocabularies(commands: DataFrame) -> tuple[Column, Column]:
    """All words of a command's description, and those of its first lines."""
    all_ = F.concat_ws(" ", "title", "function", F.array_join(F.transform("parameters", lambda p: F.concat_ws(" ", p["name"], p["info"])), " "))
    short = F.concat_ws(" ", "title", first_line(F.col("function")), F.array_join(F.transform("parameters", lambda p: F.concat_ws(" ", p["name"], first_line(p["info"]))), " "))
    return text.words(all_), text.words(short)


def weights(commands: DataFrame) -> DataFrame:
    """term, df, w: inverse document frequency over the commands."""
    n = commands.agg(F.count("*").alias("n"))
    return document_frequency(commands, vocabularies(commands)[0]).crossJoin(F.broadcast(n)).select("term", "df", inverse_frequency(F.col("df"), F.col("n")).alias("w"))  # one row


def general_views(commands: DataFrame, least: int = 3) -> DataFrame:
    """The views in which most commands with an inverse form are configured; learned, not listed."""
    t = F.transform("clis", lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", " ")))
    inverse = F.exists(t, lambda x: F.array_contains(t, F.regexp_replace(x, r"^\S+ ", "")) & x.contains(" "))
    v = commands.filter(inverse).select("section", F.explode(F.array_distinct(F.transform("views", text.casefold))).alias("view")).groupBy("view").agg(F.count("*").alias("n"))
    return v.withColumn("m", F.max("n").over(Window.partitionBy())).filter(f"n = m AND n >= {least}").select("view")  # one row for each view


def anchors(commands: DataFrame, aliases: DataFrame, w: DataFrame, n: int) -> DataFrame:
    """phrase (an array of words), section: names, and their ends of two words and more; of a large corpus only names with a word that is rare."""
    terms = text.words(bare(F.col("alias")))
    d = aliases.join(commands.select("section"), "section", "left_semi").select("section", terms.alias("terms")).filter(F.size("terms") > 0).distinct()
    if n >= 100:
        rare = w.filter(F.col("df") <= n * 0.25).select("term")
        d = d.withColumn("__t", F.explode("terms")).join(rare, F.col("__t") == rare["term"], "left_semi").drop("__t").distinct()
    starts = F.when(F.size("terms") > 2, F.concat(F.array(F.lit(1)), F.sequence(F.lit(2), F.size("terms") - 1))).otherwise(F.array(F.lit(1)))
    return d.select("section", F.explode(F.transform(starts, lambda i: F.slice("terms", i, F.size("terms")))).alias("phrase")).distinct()


def parameter_topics(commands: DataFrame, aliases: DataFrame) -> DataFrame:
    """src, pos, section, similarity, title, description: the one command that each parameter is about, if one is best.

    Phrases are found by their first word and length (an equi-join), the longest at a place wins and
    uses up its words.  Homonyms are chosen by views and outline, topics by support and similarity,
    rounded so that the order of sums decides nothing; ties give no topic.
    """
    n = commands.count()
    w = weights(commands)
    unseen = F.lit(1.0) + F.log(F.lit(float(n + 1)))
    a = anchors(commands, aliases, w, n)
    p = commands.select(F.col("section").alias("src"), "views", F.col("start_page").alias("sp"), F.posexplode("parameters").alias("pos", "p"), F.transform("parameters", lambda x: text.words(x["name"])).alias("names"))
    p = p.select("src", "views", "sp", "pos", "names", F.col("p.name").alias("name"), F.col("p.info").alias("info"))
    lines = p.select("src", "pos", F.explode(F.array(F.struct(F.lit(0).alias("part"), text.words(F.col("name")).alias("t")), F.struct(F.lit(1).alias("part"), text.words(F.col("info")).alias("t")))).alias("x")).select("src", "pos", "x.part", "x.t")
    at = lines.select("src", "pos", "part", "t", F.posexplode("t").alias("i", "first"))
    phrases = a.select("phrase").distinct().withColumn("first", F.col("phrase")[0])
    hits = at.join(phrases, "first").filter(F.slice("t", F.col("i") + 1, F.size("phrase")) == F.col("phrase"))
    hits = hits.groupBy("src", "pos", "part").agg(F.array_sort(F.collect_list(F.struct("i", (-F.size("phrase")).alias("n"), "phrase"))).alias("h"))
    take = lambda acc, x: F.when(x["i"] >= acc["end"], F.struct((x["i"] - x["n"]).alias("end"), F.concat(acc["out"], F.array(x["phrase"])).alias("out"))).otherwise(acc)
    used = hits.select("src", "pos", F.explode(F.aggregate("h", F.struct(F.lit(0).alias("end"), F.array().cast("array<array<string>>").alias("out")), take)["out"]).alias("phrase")).distinct()
    c = used.join(a, "phrase").filter("src <> section")
    target = commands.select("section", F.col("views").alias("tv"), F.col("start_page").alias("tp"), "title", vocabularies(commands)[1].alias("summary"))
    fold = lambda v: F.transform(v, text.casefold)
    c = c.join(p, ["src", "pos"]).join(target, "section")
    scope = general_views(commands).agg(F.collect_set("view").alias("general"))  # no more than the views there are
    c = c.crossJoin(F.broadcast(scope)).withColumn("tvf", fold(F.col("tv"))).withColumn("svf", fold(F.col("views")))
    c = c.filter((F.size("general") == 0) | (F.size("tvf") == 0) | F.arrays_overlap("tvf", F.concat("general", "svf")))
    counts = commands.select(F.explode(F.array_distinct("views")).alias("v")).groupBy(text.casefold(F.col("v")).alias("v")).agg(F.count("*").alias("vn"))
    scopes = target.select("section", F.explode_outer(fold(F.col("tv"))).alias("v")).join(counts, "v", "left").groupBy("section").agg(F.coalesce(F.max("vn"), F.lit(0)).alias("scope"))
    squares = lambda d, key: d.join(w, "term", "left").groupBy(*key).agg(F.sum(F.pow(F.coalesce("w", unseen), 2)).alias("sq"))
    norm = squares(target.select("section", F.explode(F.array_distinct("summary")).alias("term")), ["section"]).withColumnRenamed("sq", "t2")
    own = p.select("src", "pos", F.explode(F.array_distinct(text.words(F.concat_ws(" ", "name", first_line(F.col("info")))))).alias("term"))
    mine = squares(own, ["src", "pos"]).withColumnRenamed("sq", "s2")
    pairs = c.select("src", "pos", "section").distinct()
    shared = pairs.join(own, ["src", "pos"]).join(target.select("section", F.explode(F.array_distinct("summary")).alias("term")), ["section", "term"])
    both = squares(shared, ["src", "pos", "section"]).withColumnRenamed("sq", "both")
    c = c.join(both, ["src", "pos", "section"], "left").join(mine, ["src", "pos"], "left").join(norm, "section", "left").join(scopes, "section", "left")
    sim = F.coalesce(F.round(F.col("both") / F.sqrt(F.col("s2") * F.col("t2")), 9), F.lit(0.0))
    rank = F.struct((text.words(bare(F.col("title"))) == F.col("phrase")).alias("exact"), F.arrays_overlap("svf", "tvf").alias("view"), F.coalesce("scope", F.lit(0)).alias("scope"), text.common_prefix(F.col("src"), F.col("section")).alias("branch"), (-text.page_distance(F.col("sp"), F.col("tp"))).alias("near"), sim.alias("sim"))
    c = c.withColumn("sim", sim).withColumn("rank", rank)
    by = Window.partitionBy("src", "pos", "phrase")
    c = c.withColumn("best", F.max("rank").over(by)).filter(F.col("rank") == F.col("best")).withColumn("ties", F.count("*").over(by)).filter(f"ties = 1 AND sim >= {FLOOR}")
    support = F.size(F.filter("names", lambda x: text.contains_phrase(x, F.col("phrase"))))
    c = c.withColumn("score", F.struct(text.contains_phrase(text.words(F.col("name")), F.col("phrase")).alias("own"), support.alias("support"), F.col("sim").alias("sim")))
    c = c.groupBy("src", "pos", "section", "title", "name", "info").agg(F.max("score").alias("score"))
    top = Window.partitionBy("src", "pos")
    c = c.withColumn("best", F.max("score").over(top)).filter(F.col("score") == F.col("best")).withColumn("ties", F.count("*").over(top)).filter("ties = 1")
    return c.select("src", "pos", "section", F.col("score.sim").alias("similarity"), "title", F.concat(F.lit("Parameter "), "name", F.lit(": "), "info").alias("description"))
