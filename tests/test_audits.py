from quarry.plans import audits as A


def test_source_to_corpus(spark):
    t = spark.createDataFrame([("1", "a  b", 1, 2, "X"), ("2", "c", 3, 3, "y"), ("4", "d", 4, 4, "z")], "section string, title string, first_page int, last_page int, sha256 string")
    r = spark.createDataFrame([("1", "a b", 1, 2, "x"), ("2", "c", 3, 4, "q"), ("3", "n", 5, 5, None)], "section string, title string, first_page int, last_page int, source_sha256 string")
    found = {(x["k" if "k" in x else "section"], x["issue"]) for x in A.source_to_corpus(t, r).collect()}
    assert found == {("2", "pages"), ("2", "hash"), ("4", "missing"), ("3", "unexpected")}


def test_warnings_and_pages(spark):
    c = spark.createDataFrame([("1", 1, ["a: x", "a: y", "b"]), ("2", 2, ["a: z"])], "section string, ord int, warnings array<string>")
    assert {(r["category"], r["occurrences"], r["commands"], len(r["samples"])) for r in A.warning_review(c).collect()} == {("a", 3, 2, 2), ("b", 1, 1, 1)}
    page = "page int, text string, width double, height double, images int"
    s = spark.createDataFrame([(1, "x", 1.0, 1.0, 0), (2, None, 1.0, 1.0, 1)], page)
    o = spark.createDataFrame([(5, "x", 1.0, 1.0, 0), (6, None, 1.0, 1.0, 0)], page)
    assert [tuple(r) for r in A.selected_pages(s, o, 5).collect()] == [(2, "images")]
    t = "k int, text string"
    assert [tuple(r) for r in A.text_loss(spark.createDataFrame([(1, "a a b")], t), spark.createDataFrame([(1, "a b c")], t), "k").collect()] == [(1, "a", 1)]
