import pytest
from pyspark.sql import functions as F

from quarry.plans import parsing
from quarry.plans.profiles import profile
from quarry.sources import html as H

def section(name, inside, title):
    return f'<div class="{name}"><h2>{title}</h2>{inside}</div>' if name else f"<div><h2>{title}</h2>{inside}</div>"


#: A topic page as a device's manual would have it; the class names are fixed.
TOPIC = (
    "<html><body><ul><li>Home</li></ul><div class='articleBoxWithoutHead'><h1>mirror port</h1><style>p { }</style>"
    + section("clifunc", "<p>Copies what a port <i>receives</i> to another.</p>", "Function")
    + section("cliformat", "<p><b>mirror port</b> <i>slot-id</i> { <b>in</b> | <b>both</b> }</p><p><b>undo mirror</b></p>", "Format")
    + section("cliparam", "<table><thead><tr><th>Parameter</th><th>Description</th><th>Value</th></tr></thead><tr><td>slot-id</td><td>The slot.</td><td>0 to 7</td></tr></table>", "Parameters")
    + section("", "<p>Interface view</p>", "Views")
    + section("cliexample", "<p># Copy it.</p><pre>&lt;CORE&gt; system-view\n[CORE] mirror port 4 both</pre>", "Example")
    + "</div></body></html>"
)


def test_topic_to_command(spark):
    p = profile("ne40e-rendered")
    topics = spark.createDataFrame([("d", 1, TOPIC), ("d", 2, None)], "doc_id string, number int, html string")
    marks = spark.createDataFrame([("d", 1, "1.1 mirror port", 1, 1)], parsing.OUTLINE)
    c = parsing.parse(H.topic_events(topics), parsing.outline_entries(marks, p), p).collect()
    assert len(c) == 1 and c[0]["clis"] == ["mirror port <slot-id> { in | both }", "undo mirror"]
    assert [tuple(x) for x in c[0]["parameters"]] == [("slot-id", "The slot.\n0 to 7")]
    assert c[0]["examples"] == [["<CORE> system-view", "[CORE] mirror port 4 both"]] and c[0]["function"] == "Copies what a port receives to another." and c[0]["warnings"] == []


def test_article_needs_a_title():
    with pytest.raises(ValueError, match="title"):
        H.article("<body><p>x</p></body>")
    assert H.article(TOPIC).headings == ["Function", "Format", "Parameters", "Views", "Example"]


def test_contents(spark):
    item = lambda n, p: f'<li><object type="text/sitemap"><param name="Name" value="{n}"><param name="Local" value="{p}"></object>'
    text = f"<ul>{item('Book', 'b.html')}<ul>{item('Commands', 'c.html')}<ul>{item('demo', 'x.html#a')}{item('again', 'x.html')}</ul>{item('Log', 'l.html')}</ul></ul>"
    e = H.contents_entries(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    assert [(r["depth"], r["title"]) for r in e.orderBy("ord").collect()] == [(1, "Book"), (2, "Commands"), (3, "demo"), (3, "again"), (2, "Log")]
    s = H.subtree(e, F.col("title") == "Commands")
    pages = spark.createDataFrame([("d", "x.html", TOPIC), ("d", "c.html", "<h1>c</h1>")], "doc_id string, path string, html string")
    assert [(r["number"], r["path"], r["title"]) for r in H.topics_of(s, pages).collect()] == [(1, "x.html", "demo")]


@pytest.mark.parametrize(("link", "path"), [("b.html#x", "a/b.html"), ("../c%20d.html", "c d.html"), ("../../x", None), ("http://h/x", None), ("/x", None)])
def test_links_stay_inside(link, path):
    assert H.resolved("a", link) == path


def test_tree(spark):
    children = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b")], "parent string, ord int, child string")
    roots = spark.createDataFrame([(1, "r")], "ord int, node string")
    pages = spark.createDataFrame([("r", "<h1>r</h1>"), ("a", TOPIC), ("b", "<h1>b</h1>")], "path string, html string")
    assert {(r["node"], r["command"]) for r in H.tree_topics(children, roots, pages).collect()} == {("r", False), ("a", True), ("b", False)}
