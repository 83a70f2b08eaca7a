import resource

import duckdb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import udfs as U
from quarry.operators import matching as M
from quarry.plans import catalogue as C

#: Pages whose first heading a parser reads otherwise than the SQL does, or a regex of another dialect would.
PAGES = [
    "<h1>a&amp;&amp</h1>", "<h1>a <b>b</b>&nbsp;&eacute; c</h1><h1>d</h1>", "<h1> </h1><h1>x</h1>", "<h1></h1>", "<H1>x</H1>", "<h1>open", "<h1", "<h1 a<h1>x</h1>", "<h1><h1>x</h1></h1>", "<h1x>y</h1>",
    "<!-- <h1>no</h1> --><h1>x</h1>", "<script><h1>s</h1></script>", "<h1 class='a\nb'>one\n\ttwo\x0bthree\x0c four\r\n</h1>", "<h1>\u00a0 a\u00a0b \u3000</h1>", "<h1> a \u0085</h1>", "<h1> a \u2028\n</h1>",
    "<h1>&amp;lt;&#x27;&#39;&quot;&lt;p&gt;</h1>", "</h1><h1>after</h1>", "<h1>a</h1 ><h1>b</h1>", "<h2>x</h2>", "", None, "<h1>\U0001f600&amp;</h1>", "<h1>" * 20000,
]


def test_html_headings_as_the_sql(spark, tmp_path):
    spark.createDataFrame(list(enumerate(PAGES)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    found = dict(C.QUERIES["html_headings"](spark, str(tmp_path)).collect())
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW pages AS FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert found == dict(c.execute(C.ORACLE_SQL["html_headings"]).fetchall())


#: Marks, numbers other than digits, ties, a key on two rows, null keys and texts, documents of fewer than three terms.
TEXTS = [
    (1, "a a a b b c d e f g"), (2, "a b c d e"), (3, "ÁB café x² ½ Ⅷ _y_z"), (4, "one"), (5, ""), (6, None), (7, "q q r"), (7, "q r s t"), (None, "a n n"), (None, "m a"),
    *((10 + i, f"a the the b{i % 3} w{i} " + "c " * (i % 7)) for i in range(40)),
]


def test_top_terms_as_the_sql(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = C.QUERIES["tfidf_top_terms"](spark, str(tmp_path)).collect()
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        wanted = c.execute(C.ORACLE_SQL["tfidf_top_terms"]).fetchall()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_few_terms_go_to_their_weight(spark):
    """A document's frequent terms stay behind if three others are certain to be better, whatever the bound."""
    f = spark.createDataFrame([("the", 900), ("of", 800), *((f"t{i}", 5) for i in range(9))], "term string, df long")
    tf = spark.createDataFrame([(1, "the", 2), (1, "of", 2), *((1, f"t{i}", 9 if i < 3 else 1) for i in range(9)), (2, "the", 1)], "doc_id long, term string, n long")
    rows = spark.createDataFrame([(1000,)], "rows long")
    for heavy in (1, 100, 10**6):
        found = {(r["doc_id"], r["term"]) for r in M.likely_terms(tf, f, rows, "doc_id", 3, heavy).collect()}
        assert {(1, "t0"), (1, "t1"), (1, "t2"), (2, "the")} <= found
        assert heavy == 1 or found == {(1, "t0"), (1, "t1"), (1, "t2"), (2, "the")}


def test_pages_go_to_python_in_small_batches(spark):
    """4,000 pages of 100 KB in one task: 400 MB of text, and a worker that holds few of them at once."""
    page = F.concat(F.lit("<p>"), F.repeat(F.lit("x"), 100_000), F.lit("</p>"), F.col("id").cast("string"))
    held = U.each(T.LongType(), lambda h: len(U.text_of(h)) * 0 + resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
    assert spark.range(0, 4000, 1, 1).select(held(page).alias("mb")).agg(F.max("mb")).first()[0] < 200
    assert [r[0] for r in spark.createDataFrame([("<p>a<br>b</p>",), (None,)], "html string").select(U.source_text("html")).collect()] == ["a\nb", None]
