"""The catalogue of queries: the reference's operators over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import udfs as U
from ..operators import matching as M
from ..operators import ordered as O
from . import audits as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TERMS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


@query(f"SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({TERMS})) AS term FROM documents) GROUP BY term")
def term_document_frequency(t):
    return M.document_frequency(t("documents"), T.terms(F.col("text")))


IDF = f"""WITH n AS (SELECT count(*) AS n FROM documents),
f AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({TERMS})) AS term FROM documents) GROUP BY term),
idf AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS w FROM f, n)"""


def idf(t):
    n = t("documents").agg(F.count("*").alias("n"))
    f = M.document_frequency(t("documents"), T.terms(F.col("text")))
    return f.crossJoin(F.broadcast(n)).select("term", M.inverse_frequency(F.col("df"), F.col("n")).alias("w"))  # one row


@query(IDF + " SELECT term, round(w, 6) AS idf FROM idf")
def term_idf(t):
    return idf(t).select("term", F.round("w", 6).alias("idf"))


@query(IDF + f""", tf AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({TERMS}) AS term FROM documents) GROUP BY ALL)
SELECT doc_id, term, score, rank FROM (SELECT doc_id, term, round(n * w, 6) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY round(n * w, 6) DESC, term) AS rank FROM tf JOIN idf USING (term)) WHERE rank <= 3""")
def tfidf_top_terms(t):
    """Texts are dealt by document, so that each counts its own terms in place; only the likely ones go to their term's weight."""
    docs = t("documents").select("doc_id", "text").repartition("doc_id")
    n = t("documents").agg(F.count("*").alias("rows"))  # one row
    f = M.document_frequency(docs, T.terms(F.col("text"))).filter("term IS NOT NULL")  # as its joins infer: else it is made twice
    tf = docs.select("doc_id", F.explode(T.terms(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("n"))
    d = M.likely_terms(tf, f, n, "doc_id", 3).join(f, "term").crossJoin(F.broadcast(n))
    d = d.select("doc_id", "term", F.round(F.col("n") * M.inverse_frequency(F.col("df"), F.col("rows")), 6).alias("score"))
    return O.numbered(d, ["doc_id"], [F.desc("score"), F.asc("term")], "rank").filter("rank <= 3")


@query(r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents) GROUP BY word")
def word_census(t):
    return t("documents").select(F.explode(T.census_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query(r"""WITH w AS (SELECT lang, doc_id % 2 AS half, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents)
SELECT lang, word, count(*) FILTER (half = 0) - count(*) FILTER (half = 1) AS missing FROM w GROUP BY ALL HAVING missing > 0""")
def multiset_text_loss(t):
    """Words that the even documents of a language hold more often than the odd ones."""
    w = t("documents").select("lang", (F.col("doc_id") % 2).alias("half"), F.explode(T.census_words(F.col("text"))).alias("word"))
    return M.multiset_difference(w.filter("half = 0"), w.filter("half = 1"), ["lang", "word"])


SEGMENTS = "SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS segment FROM conversations"


@query(f"SELECT conv_id, segment::BIGINT AS segment, count(*) AS n_turns, min(turn) AS first_turn, max(turn) AS last_turn FROM ({SEGMENTS}) WHERE segment > 0 GROUP BY conv_id, segment")
def turn_segments(t):
    d = O.segments(t("conversations"), ["conv_id"], ["turn"], F.col("role") == "user").filter("segment > 0")
    return d.groupBy("conv_id", "segment").agg(F.count("*").alias("n_turns"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS user_turn FROM conversations")
def asof_user_turn(t):
    return O.filled(t("conversations"), ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "user_turn").select("conv_id", "turn", "user_turn")


@query("""WITH g AS (SELECT *, ts - lag(ts) OVER w > INTERVAL 12 HOUR AS far, row_number() OVER w = 1 AS head FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN head OR far THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, run::BIGINT AS run, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM s GROUP BY user_id, run""")
def gap_sessions(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1e6
    e = t("events").withColumn("gap", seconds(F.col("ts")) - seconds(F.lag("ts").over(w)))
    d = O.gap_groups(e, ["user_id"], ["ts", "event_id"], F.col("gap"), 12 * 3600)
    return d.groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT doc_id, i, line, lag(line) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM l)
SELECT doc_id, md5(string_agg(CASE WHEN prev IS NULL OR prev LIKE '%-' THEN '' WHEN prev LIKE '%.' THEN chr(10) ELSE ' ' END || line, '' ORDER BY i)) AS text_md5 FROM p GROUP BY doc_id""")
def paragraph_join(t):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return O.joined_lines(lines, ["doc_id"], "i").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


OUTLINE = """o0 AS (SELECT r_regionkey AS a, -1 AS b, -1 AS c, 1 AS level FROM region UNION ALL SELECT n_regionkey, n_nationkey, -1, 2 FROM nation
  UNION ALL SELECT n_regionkey, n_nationkey, c_custkey, 3 FROM customer JOIN nation ON c_nationkey = n_nationkey),
o AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY b, c) AS idx FROM o0), p AS (SELECT *, 1 + idx // 10 AS page FROM o)"""


def outline(t):
    n = t("nation")
    rows = t("region").select(F.col("r_regionkey").alias("a"), F.lit(-1).alias("b"), F.lit(-1).cast("long").alias("c"), F.lit(1).alias("level"))
    rows = rows.unionByName(n.select(F.col("n_regionkey").alias("a"), F.col("n_nationkey").alias("b"), F.lit(-1).cast("long").alias("c"), F.lit(2).alias("level")))
    rows = rows.unionByName(t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("a"), F.col("n_nationkey").alias("b"), F.col("c_custkey").alias("c"), F.lit(3).alias("level")))
    return O.numbered(rows, ["a"], [F.asc("b"), F.asc("c")], "idx").withColumn("page", 1 + F.floor(F.col("idx") / 10))


@query(f"WITH {OUTLINE} SELECT a, b, c FROM p QUALIFY coalesce(lead(level) OVER (PARTITION BY a ORDER BY idx) <= level, true)")
def outline_leaf_nodes(t):
    return O.leaves(outline(t), ["a"]).select("a", "b", "c")


@query(f"""WITH {OUTLINE}, x AS (SELECT p.*, max(page) OVER (PARTITION BY a) AS pages FROM p WHERE level < 3 OR true)
SELECT a, b, c, page AS first_page, coalesce((SELECT q.page FROM x q WHERE q.a = x.a AND q.idx > x.idx AND q.level <= x.level ORDER BY q.idx LIMIT 1), pages) AS last_page FROM x""")
def section_page_range(t):
    d = outline(t).withColumn("pages", F.max("page").over(Window.partitionBy("a")))
    return O.page_ranges(d, F.col("pages"), ["a"], 3).select("a", "b", "c", "first_page", "last_page")


@query("""WITH n AS (SELECT 'r' || r_regionkey AS node, [r_regionkey + 1] AS path FROM region UNION ALL SELECT 'n' || n_nationkey, [n_regionkey + 1, n_nationkey + 1] FROM nation)
SELECT node, len(path)::INT AS depth, row_number() OVER (ORDER BY path) AS pos FROM n""")
def hierarchy_preorder(t):
    roots = t("region").select((F.col("r_regionkey") + 1).alias("ord"), F.concat(F.lit("r"), "r_regionkey").alias("node"))
    children = t("nation").select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), (F.col("n_nationkey") + 1).alias("ord"), F.concat(F.lit("n"), "n_nationkey").alias("child"))
    d = M.preorder(children, roots)
    return d.select("node", "depth", F.row_number().over(Window.orderBy("path")).alias("pos"))  # a tree of 30 nodes


@query("SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY lower(regexp_extract(c_name, '^[^0-9]*')), CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT)) AS pos FROM customer")
def natural_sort_rank(t):
    return O.numbered(t("customer").withColumn("k", T.natural_key(F.col("c_name"))), ["c_nationkey"], [F.asc("k")], "pos").select("c_nationkey", "c_custkey", "pos")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_sections(t):
    return M.missing(t("orders").select("o_orderkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("""WITH l AS (SELECT l_orderkey AS k, count(*) AS n, max(l_linestatus) AS s FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders),
j AS (SELECT coalesce(o.k, l.k) AS k, o.k IS NULL AS nol, l.k IS NULL AS nor, o.s AS a, l.s AS b, n FROM o FULL JOIN l ON o.k = l.k)
SELECT k, unnest(list_filter([CASE WHEN nor THEN 'missing' END, CASE WHEN nol THEN 'unexpected' END, CASE WHEN NOT nol AND NOT nor AND a IS DISTINCT FROM b THEN 'status' END, CASE WHEN NOT nol AND NOT nor AND n IS DISTINCT FROM 4 THEN 'lines' END], lambda x: x IS NOT NULL)) AS issue FROM j""")
def reconcile_full_outer(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"), F.max("l_linestatus").alias("b"))
    orders = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("a"))
    return M.reconciled(orders, lines, "k", {"status": (F.col("a"), F.col("b")), "lines": (F.col("n"), F.lit(4).cast("long"))})


FILE = "regexp_replace(regexp_replace(substr(regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 100), '^$', 'command'), '$', '.json')"


@query(f"SELECT p_partkey, p_partkey::VARCHAR || '_' || {FILE} AS file FROM part")
def safe_filename(t):
    return t("part").select("p_partkey", T.filename(F.col("p_partkey").cast("string"), F.col("p_name")).alias("file"))


@query(f"SELECT {FILE} AS file, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def manifest_duplicates(t):
    return t("part").groupBy(T.filename(F.lit(""), F.col("p_name")).alias("file")).agg(F.count("*").alias("n")).filter("n > 1")


@query("""SELECT count(*) AS commands, sum(len(string_split(text, chr(10))))::BIGINT AS templates, count(*) FILTER (text <> '') AS commands_with_text, count(*) FILTER (contains(text, '|')) AS commands_with_bars,
 count(DISTINCT source) AS sources FROM documents""")
def field_report(t):
    return t("documents").agg(F.count("*").alias("commands"), F.sum(F.size(F.split("text", "\n"))).alias("templates"), F.count_if(F.col("text") != "").alias("commands_with_text"), F.count_if(F.contains("text", F.lit("|"))).alias("commands_with_bars"), F.count_distinct("source").alias("sources"))


@query("SELECT lang, quality, toxic, count(*) AS n, round(avg(n_chars), 6) AS chars FROM documents JOIN labels USING (doc_id) GROUP BY lang, quality, toxic")
def label_histogram(t):
    return t("documents").join(t("labels"), "doc_id").groupBy("lang", "quality", "toxic").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 6).alias("chars"))


@query("""WITH w AS (SELECT event_type || ': user ' || user_id AS w, user_id, event_id FROM events)
SELECT split_part(w, ':', 1) AS category, count(*) AS n, count(DISTINCT user_id) AS users FROM w GROUP BY 1""")
def warning_categories(t):
    w = t("events").select(F.concat("event_type", F.lit(": user "), "user_id").alias("w"), "user_id")
    return w.groupBy(T.category(F.col("w")).alias("category")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS k FROM (SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2)) WHERE k <= 3")
def sample_per_category(t):
    """The first three users of each type of event, once each."""
    once = t("events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))
    return O.first_of_each(once, ["event_type"], [F.asc("user_id")], 3).select("event_type", "user_id", "event_id")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 30")
def top_targets(t):
    return t("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(30)


@query("""WITH s AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, event_type, n FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS r, count(*) OVER (PARTITION BY user_id, n) AS c FROM s) WHERE r = 1 AND c = 1""")
def unique_best_match(t):
    s = t("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return O.unique_best(s, ["user_id"], F.col("n"))


@query("WITH n AS (SELECT c_mktsegment AS view, count(*) AS n FROM customer GROUP BY 1) SELECT view, n FROM n WHERE n = (SELECT max(n) FROM n) AND n >= 3")
def general_scope_views(t):
    return M.general_scopes(t("customer").select(F.col("c_mktsegment").alias("view")))


@query("""WITH w AS (SELECT p_name AS name, p_partkey AS section, string_split(p_name, ' ') AS w FROM part),
p AS (SELECT array_to_string(w[1:n], ' ') AS prefix, section, name FROM (SELECT *, unnest(range(2, len(w))) AS n FROM w))
SELECT prefix, min(section) AS section, min(name) AS name FROM p GROUP BY prefix HAVING count(DISTINCT section) = 1""")
def unique_prefix_abbreviation(t):
    return M.unique_prefixes(t("part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("section")))


@query("""WITH f AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS k FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY k, l_suppkey) AS suppliers FROM f GROUP BY 1""")
def ordered_distinct_merge(t):
    d = M.ordered_distinct(t("lineitem"), ["l_orderkey"], "l_linenumber", "l_suppkey", "s")
    return d.select("l_orderkey", F.array_join(F.transform("s", lambda x: x.cast("string")), ",").alias("suppliers"))


@query("""WITH e AS (SELECT o_custkey AS src, l_suppkey AS dst, min(o_orderkey * 10 + l_linenumber) AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey <> l_suppkey GROUP BY 1, 2),
n AS (SELECT src, s_name, min(k) AS k FROM e JOIN supplier ON dst = s_suppkey GROUP BY 1, 2)
SELECT src, string_agg(s_name, ',' ORDER BY k, s_name) AS files FROM n GROUP BY 1""")
def edge_target_files(t):
    e = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    e = e.groupBy(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst")).agg(F.min(F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    names = t("supplier").select(F.col("s_suppkey").alias("section"), F.col("s_name").alias("file"))
    return M.target_files(e, names).select("src", F.array_join("files", ",").alias("files"))


@query("""WITH e AS (SELECT DISTINCT o_custkey AS src, p_brand AS name, l_suppkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
j AS (SELECT src, name, dst, c_nationkey = s_nationkey AS v, s_name = name AS ti FROM e JOIN customer ON c_custkey = src JOIN supplier ON s_suppkey = dst),
k AS (SELECT *, max(v) OVER w AS av, max(ti) OVER w AS ati FROM j WINDOW w AS (PARTITION BY src, name))
SELECT src, name, dst FROM k WHERE CASE WHEN av THEN v WHEN ati THEN ti ELSE true END""")
def homonym_context(t):
    e = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    e = e.select(F.col("o_custkey").alias("src"), F.col("p_brand").alias("name"), F.col("l_suppkey").alias("dst")).distinct()
    sources = t("customer").select(F.col("c_custkey").alias("src"), F.array("c_nationkey").alias("views"))
    targets = t("supplier").select(F.col("s_suppkey").alias("dst"), F.col("s_name").alias("title"), F.array("s_nationkey").alias("dst_views"))
    return M.homonyms(e, sources, targets)


RULES = "r AS (SELECT event_type, event_id AS rule, value AS low, value + 0.5 AS high FROM events WHERE event_id % 50 = 0)"


def rules(t):
    return t("events").filter("event_id % 50 = 0").select("event_type", F.col("event_id").alias("rule"), F.col("value").alias("low"), (F.col("value") + 0.5).alias("high"))


@query(f"WITH {RULES} SELECT event_id, rule FROM events e JOIN r USING (event_type) WHERE value BETWEEN low AND high")
def range_rule_rows(t):
    """Events with the rules that hold them; only events whose id is divisible by 50 are rules, here and in the SQL."""
    return M.in_ranges(t("events"), rules(t), ["event_type"], "value", "low", "high", 0.5).select("event_id", "rule")


@query(f"WITH {RULES} SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.event_type = e.event_type AND e.value BETWEEN low AND high)")
def spatial_exclusion(t):
    """Events that no rule holds; only events whose id is divisible by 50 are rules, so other events' ranges exclude nothing."""
    return M.outside_ranges(t("events"), rules(t), ["event_type"], "value", "low", "high", 0.5).select("event_id")


@query(r"""SELECT doc_id, md5(regexp_replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '([\\`*_{}\[\]#!|>~+-])', '\\\1', 'g')) AS md5 FROM documents""")
def markdown_escape(t):
    return t("documents").select("doc_id", F.md5(T.prose(F.col("text")).cast("binary")).alias("md5"))


@query("""WITH f AS (SELECT doc_id, text, repeat('`', greatest(3, 1 + coalesce(list_max(list_transform(regexp_extract_all(text, '`+'), lambda x: length(x))), 0))) AS f FROM documents)
SELECT doc_id, md5(f || 'text' || chr(10) || text || chr(10) || f) AS md5 FROM f""")
def code_fence(t):
    return t("documents").select("doc_id", F.md5(T.code_block(F.col("text")).cast("binary")).alias("md5"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_roundtrip(t):
    again = F.to_json(F.from_json("props", "k BIGINT"), {"ignoreNullFields": "false"})
    return t("events").select("event_id", F.get_json_object(again, "$.k").cast("long").alias("k"))


@query(r"SELECT lang, count(*) FILTER (regexp_matches(text, '[\x{0400}-\x{04FF}]')) AS cyrillic, count(*) FILTER (regexp_matches(text, '[\x{00C0}-\x{024F}]')) AS latin, count(*) AS n FROM documents GROUP BY lang")
def script_scan(t):
    return t("documents").groupBy("lang").agg(F.count_if(F.col("text").rlike("[\\u0400-\\u04FF]")).alias("cyrillic"), F.count_if(F.col("text").rlike("[\\u00C0-\\u024F]")).alias("latin"), F.count("*").alias("n"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256_text(t):
    return t("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query(r"""SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), lambda x: replace(replace(replace(replace(replace(trim(regexp_replace(x, '\s+', ' ', 'g')), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'))[1] AS heading FROM pages""")
def html_headings(t):
    return t("pages").select("page_id", T.first_heading(F.col("html")).alias("heading"))


@query()
def html_source_text(t):
    """The MD5 of each page's text; SQL has no HTML parser."""
    return t("pages").select("page_id", F.md5(U.source_text("html").cast("binary")).alias("text_md5"))


@query("""WITH o AS (SELECT event_type, user_id, min(event_id) AS ord FROM events GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ord, user_id) AS r FROM o)
SELECT event_type AS category, count(*) AS occurrences, count(DISTINCT user_id) AS commands, (SELECT string_agg(user_id::VARCHAR, ',' ORDER BY r) FROM k WHERE k.event_type = e.event_type AND r <= 3) AS samples FROM events e GROUP BY event_type""")
def warning_review(t):
    firsts = t("events").select(F.col("user_id").alias("section"), F.col("event_id").alias("ord"), F.array(F.concat("event_type", F.lit(": "), "event_id")).alias("warnings"))
    return A.warning_review(firsts).withColumn("samples", F.array_join(F.transform("samples", lambda x: x["section"].cast("string")), ","))


@query("""WITH b AS (SELECT o_custkey AS section, list_sort(list_distinct(list(o_orderpriority))) AS p FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), a AS (SELECT o_custkey AS section, list_sort(list_distinct(list(o_orderpriority))) AS p FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1),
j AS (SELECT coalesce(a.section, b.section) AS section, list_filter(coalesce(a.p, []), lambda x: NOT list_contains(coalesce(b.p, []), x)) AS added, list_filter(coalesce(b.p, []), lambda x: NOT list_contains(coalesce(a.p, []), x)) AS removed FROM a FULL JOIN b USING (section))
SELECT section, array_to_string(added, ',') AS added, array_to_string(removed, ',') AS removed FROM j WHERE len(added) + len(removed) > 0""")
def edge_diff(t):
    half = lambda n: t("orders").filter(F.col("o_orderkey") % 2 == n).groupBy(F.col("o_custkey").alias("section")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("p"))
    d = M.edge_changes(half(0), half(1), "section", "p").filter(F.size("added") + F.size("removed") > 0)
    return d.select("section", F.array_join(F.array_sort("added"), ",").alias("added"), F.array_join(F.array_sort("removed"), ",").alias("removed"))
