from quarry.operators import layout as L

BOX = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double"


def test_rows_between_rules(spark):
    d = spark.createDataFrame([("d", 1, 130.04, y, 400.0, y) for y in (10.0, 10.0, 30.0, 50.0)], BOX)
    labels = spark.createDataFrame([("d", 1, 50.0, 35.0, 60.0, 45.0)], BOX)
    rows = L.ruled_rows(L.rules(d), labels)
    assert [(r["top"], r["bottom"]) for r in rows.collect()] == [(10.0, 30.0)]
    lines = spark.createDataFrame([("d", 1, 140.0, 12.0, 150.0, 20.0), ("d", 1, 100.0, 12.0, 110.0, 20.0)], BOX)
    assert [r["x0"] for r in L.row_lines(rows, lines).select(lines["x0"]).collect()] == [140.0]
    assert tuple(L.enclosing_boxes(lines, ["doc_id"]).first()) == ("d", 100.0, 12.0, 150.0, 20.0)


def test_reading_order(spark):
    span = "array<struct<text:string,flags:int,size:double,font:string,x0:double,x1:double>>"
    rows = [("d", 1, 200.0, 10.5, 220.0, 20.0, "two", []), ("d", 1, 130.0, 12.0, 150.0, 22.0, "one", []), ("d", 1, 50.0, 10.0, 90.0, 20.0, "Label", []), ("d", 1, 130.0, 40.0, 150.0, 50.0, "next", [])]
    d = spark.createDataFrame(rows, f"{BOX}, text string, spans {span}")
    assert [r["text"] for r in L.reading_order(d).orderBy("ord").collect()] == ["Label", "one two", "next"]


def test_footer(spark):
    d = spark.createDataFrame([("d", 1, 0.0, y, 1.0, y + 5, "Issue 3") for y in (100.0, 950.0)], f"{BOX}, text string")
    h = spark.createDataFrame([("d", 1, 1000.0)], "doc_id string, page int, height double")
    assert [r["bottom"] for r in L.footer_tops(d, h, "^Issue").collect()] == [950.0]
