from pyspark.sql import functions as F

from quarry.operators import fields as X
from quarry.plans import parsing
from quarry.plans.profiles import profile


def span(t, flags=0, size=10.0, x0=50.0, font="Times"):
    return (t, flags, size, font, x0, x0 + 5.0 * len(t))


class Book:
    def __init__(self):
        self.rows, self.y, self.page = [], 60.0, 1

    def line(self, *spans, gap=10.0):
        self.y += gap
        self.rows.append(("d", self.page, len(self.rows), "line", " ".join(s[0] for s in spans), spans[0][4], self.y, spans[-1][5], self.y + 10, list(spans), None))
        self.y += 10

    def table(self, *rows):
        self.y += 10
        self.rows.append(("d", self.page, len(self.rows), "table", None, 50.0, self.y, 400.0, self.y + 10, None, [list(r) for r in rows]))
        self.y += 10

    def label(self, t):
        self.line(span(t, 16, 13.0))

    def frame(self, spark):
        return spark.createDataFrame(self.rows, X.EVENTS)


def book():
    b = Book()
    b.line(span("loose text before all"))
    b.line(span("1.1 demo", 16, 16.0))
    b.label("Function")
    b.line(span("Sets a de-"))
    b.line(span("mo."), gap=2)
    b.label("Format")
    b.line(span("For routers only"))
    b.line(span("applies:"))
    b.line(span("demo ", 16), span("name"))
    b.line(span("undo demo", 16))
    b.label("Parameters")
    b.table(["Parameter", "Description"], ["name", "A name."], [None, "1 to 9"])
    b.line(span("odd remark"))
    b.label("Views")
    b.line(span("System view, Other view."))
    b.label("Example")
    b.line(span("# Do it."))
    b.line(span("[HOST] demo a", 8, font="Courier"))
    b.line(span("b", 8, x0=80.0, font="Courier"), gap=2)
    b.line(span("output", 8, font="Courier"))
    b.line(span("# Again."))
    b.line(span("[HOST] undo demo", 8, font="Courier"))
    b.label("Related Topics")
    b.line(span("1.2 other"))
    b.line(span("thing"), gap=2)
    b.line(span("1.3 "), span("more", x0=70.0))
    b.line(span("1.2 A chapter", 16, 16.0))
    b.line(span("No labels here."))
    return b


def test_numbered_profile(spark):
    p = profile("huawei")
    marks = spark.createDataFrame([("d", 1, "1.1 demo", 1, 1), ("d", 2, "Preface", 1, 1)], parsing.OUTLINE)
    outline = parsing.outline_entries(marks, p)
    rows = parsing.parse(book().frame(spark), outline, p).collect()
    assert len(rows) == 1
    c = rows[0]
    assert (c["section"], c["title"], c["function"], c["views"]) == ("1.1", "demo", "Sets a de-mo.", ["System view", "Other view"])
    assert c["clis"] == ["demo <name>", "undo demo"]
    assert [tuple(x) for x in c["parameters"]] == [("name", "A name.\n1 to 9")]
    assert c["examples"] == [["[HOST] demo a b"], ["[HOST] undo demo"]]
    assert [x["title"] for x in c["related_topics"]] == ["1.2 other thing", "1.3 more"]
    assert "unparsed_parameter_text: odd remark" in c["warnings"] and any(x.startswith("conditional_format") for x in c["warnings"])
    assert "Format applicability (source text):" in c["extra"] and "Related Topics:\n1.2 other thing" in c["extra"]


def test_labelled_profile(spark):
    p = profile("cisco")
    b = Book()
    b.line(span("show demo", 16, 16.0))
    b.line(span("Shows a demo."))
    b.line(span("show demo ", 16), span("id", 2))
    b.label("Command Modes")
    b.line(span("EXEC"))
    b.label("Example")
    b.line(span("A configuration:"))
    b.line(span("show demo 3", 8, font="Courier"))
    b.line(span("Packet counters: 25", 8, font="Courier"))
    marks = spark.createDataFrame([("d", 1, "show demo", 1, 1)], parsing.OUTLINE)
    c = parsing.parse(b.frame(spark), parsing.outline_entries(marks, p), p).collect()[0]
    assert c["clis"] == ["show demo <id>"] and c["function"] == "Shows a demo." and c["views"] == ["EXEC"]
    assert c["examples"] == [["show demo 3", "Packet counters: 25"]]


def test_cross_page_templates(spark):
    b = Book()
    b.line(span("1.1 demo", 16, 16.0))
    b.label("Format")
    b.line(span("demo", 16))
    b.page, b.y = 2, 60.0
    b.line(span("demo", 16), span(" other", 16))
    b.page, b.y = 3, 60.0
    b.line(span("x", 0))
    p = profile("huawei")
    marks = spark.createDataFrame([("d", 1, "1.1 demo", 1, 1)], parsing.OUTLINE)
    c = parsing.parse(b.frame(spark), parsing.outline_entries(marks, p), p).collect()[0]
    assert c["clis"] == ["demo", "demo other <x>"]
    assert any(x.startswith("format_crosses_page") for x in c["warnings"])


def test_listing_needs_a_documented_command(spark):
    blocks = [
        (1, ["Packet counters: 25", "!", "interface statistics"], "", "demo", ["demo <x>"]),
        (2, ["demo abc", "junk"], "", "demo", ["demo <x>"]),
        (3, ["boot: demo abc", "version: 3", "boot: dir"], "", "demo", ["demo <x>"]),
        (4, [" demo abc ", "!", "other line"], "", "demo", ["demo <x>"]),
        (5, ["demo abc", "other line"], "The configuration is:", "x", ["demo <x>"]),
        (6, ["demo abc", "other line"], "Output of the configuration:", "x", ["no demo <x>"]),
        (7, ["show all"], "", "show all (EXEC)", []),
    ]
    d = spark.createDataFrame(blocks, "id int, lines array<string>, context string, title string, clis array<string>")
    got = {r["id"]: r["calls"] for r in X.block_calls(d, ["id"]).collect()}
    assert got == {2: ["demo abc"], 3: ["boot: demo abc", "boot: dir"], 4: ["demo abc", "other line"], 5: ["demo abc", "other line"], 6: ["demo abc"], 7: ["show all"]}


def test_related_tables_and_columns(spark):
    """Titles with their description in tables, in printed columns, and in lists."""
    word = lambda text, x0, flags=0: (text, flags, 10.0, "F", float(x0), float(x0 + 5 * len(text)))
    rows, at = [], 0

    def line(field, page, y, *spans):
        nonlocal at
        at += 1
        rows.append(("d", 1, field, page, at, "line", " ".join(s[0] for s in spans), 0.0, float(y), 90.0, float(y + 8), list(spans), None))

    def grid(field, *cells):
        nonlocal at
        at += 1
        rows.append(("d", 1, field, 1, at, "table", "", 0.0, 0.0, 90.0, 9.0, None, [list(c) for c in cells]))

    grid("Related Topics", ["Topic", "Description"], ["outer topic", "First line"], [None, "Continued"], ["", ""], ["next", None])
    line("Related Commands", 1, 0, word("Command", 0), word("Description", 60))
    line("Related Commands", 1, 20, word("clear demo", 0, 16), word("Clears", 60))
    line("Related Commands", 1, 29, word("all-", 0, 16), word("the demo.", 60))
    line("Related Commands", 1, 38, word("now", 0, 16))
    line("Related Commands", 2, 0, word("show demo", 10, 16), word("Shows it.", 75))
    line("Related Commands", 2, 9, word("Table 3: more", 0))
    line("Related Commands", 2, 18, word("set demo", 10, 16), word("Sets it.", 75))
    line("See Also", 1, 0, word("• one thing", 0))
    line("See Also", 1, 9, word("wrapped", 0))
    line("See Also", 1, 30, word("another", 0))
    schema = X.EVENTS.replace("doc_id string,", "doc_id string, command_id int, field string,")
    got = {}
    for r in X.related(spark.createDataFrame(rows, schema).withColumn("size", F.lit(10.0))).orderBy("source_section", "pos").collect():
        got.setdefault(r["source_section"], []).append((r["title"], r["description"]))
    assert got == {
        "Related Topics": [("outer topic", "First line\nContinued"), ("next", "")],
        "Related Commands": [("clear demo all-now", "Clears the demo."), ("show demo", "Shows it."), ("set demo", "Sets it.")],
        "See Also": [("one thing wrapped", ""), ("another", "")],
    }


def test_nothing(spark):
    p = profile("huawei")
    none = spark.createDataFrame([], X.EVENTS)
    assert parsing.parse(none, parsing.outline_entries(spark.createDataFrame([], parsing.OUTLINE), p), p).count() == 0
