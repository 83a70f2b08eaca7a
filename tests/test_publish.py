import json

from quarry.__main__ import main

from .test_html import TOPIC


def test_command_line(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.html").write_text(TOPIC)
    (src / "2.html").write_text(TOPIC.replace("mirror port", "peer").replace("Copies what a port <i>receives</i> to another.", "Use the mirror port command first."))
    out, rich, doc = tmp_path / "out", tmp_path / "rich", tmp_path / "all.md"
    assert main(["parse", str(src), "-o", str(out)]) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["commands"] == 2
    names = [e["file"] for e in json.loads((out / "manifest.json").read_text())["commands"]]
    assert names == ["cmd_corpus/1.1_mirror_port.json", "cmd_corpus/1.2_peer.json"]
    extra = out / names[1]
    extra.write_text(json.dumps(json.loads(extra.read_text()) | {"own": 7}))
    assert main(["enrich-related", str(out), "-o", str(rich)]) == 0
    r = json.loads((rich / names[1]).read_text())
    assert r["own"] == 7 and any(t["target_files"] == ["1.1_mirror_port.json"] for t in r["related_topics"])
    assert main(["markdown", str(rich), "-o", str(doc)]) == 0
    assert doc.read_text().startswith("# Command Corpus\n\nCommands: 2.\n\n## Contents\n\n- [mirror port](#command-1)\n")
    assert "### Related Topics" in doc.read_text()
    assert main(["enrich-related", str(out), "-o", str(rich)]) == 1
