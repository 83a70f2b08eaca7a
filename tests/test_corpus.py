import json

import pytest

from quarry.functions import text
from quarry.sources import corpus
from pyspark.sql import functions as F


def record(**more):
    return {"CLIs": ["a <x>"], "FuncDef": "Does `a`.", "ParentView": ["V"], "ParaDef": [{"Parameters": "x", "Info": "1\n2 | 3"}], "Examples": [["<H> a 1"]]} | more


def test_round_trip(spark, tmp_path):
    for name, r in (("10.json", record(PageTitle="ten")), ("2.json", record()), ("manifest.json", {})):
        (tmp_path / name).write_text(json.dumps(r))
    d = corpus.read_records(spark, str(tmp_path)).orderBy("ord")
    assert [(r["file"], r["title"]) for r in d.collect()] == [("2.json", "a <x>"), ("10.json", "ten")]
    out = json.loads(corpus.to_json(d.withColumn("section", F.lit("1")), "paper").first()["json"])
    assert out["ParentViews"] == ["V"] and out["ParaDef"] == [{"Paras": "x", "Info": "1\n2 | 3"}] and "PageTitle" not in out
    md = d.select(corpus.markdown().alias("m")).first()["m"]
    assert "## a &lt;x&gt;" in md.replace("\\", "") and "1<br>2 \\| 3" in md


def test_both_schemas_are_refused(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(record(ParentViews=["W"])))
    with pytest.raises(Exception, match="both schemas"):
        corpus.read_records(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("file", ["../x.json", "/x.json"])
def test_manifest_paths(spark, tmp_path, file):
    (tmp_path / "manifest.json").write_text(json.dumps({"commands": [{"file": file}]}))
    with pytest.raises(Exception, match="bad or repeated path"):
        corpus.manifest_entries(spark, str(tmp_path / "manifest.json")).collect()


def test_text(spark):
    d = spark.createDataFrame([("a-\nb  c", "3.1.2", "3.1.9", "x`` y")], "t string, a string, b string, c string")
    r = d.select(text.unwrap(F.col("t")), text.common_prefix(F.col("a"), F.col("b")), text.fence(F.col("c"))).first()
    assert tuple(r) == ("a-b c", 2, "```")
