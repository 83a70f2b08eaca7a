import pytest
from quarry.functions import grammar
from quarry.functions.udfs import template, text_of, topic_key, unwrap

TRUNK = "port trunk allow-pass vlan { { { <vlan-id1> [ to <vlan-id2> ] } &<1-40> } | all }"


@pytest.mark.parametrize(
    ("call", "good"),
    [("10", True), ("10 to 20 30", True), ("", False), ("10 to", True), ("ALL", True), (" ".join(map(str, range(40))), True), (" ".join(map(str, range(41))), False)],
)
def test_invocations(call, good):
    # A placeholder takes any word, "to" included; more than 40 items don't fit.
    assert grammar.matches(f"port trunk allow-pass vlan {call}".strip(), [TRUNK]) is good


@pytest.mark.parametrize("n", range(5))
def test_zero_repetition(n):
    assert grammar.matches(" ".join(["undo priority", *["1"] * n]), ["undo priority [ <priority> ] &<0-3>"]) is (n <= 3)


def test_issues():
    found = grammar.issues(["demo [ <value> }", "demo { all", "peer { <name> } &<3-1>", "a &<1-4094>", "a &<1-999999999999999999999>"])
    assert [(i["cli_index"], i["code"]) for i in found] == [(0, "unbalanced_syntax"), (1, "unbalanced_syntax"), (2, "unsupported_syntax"), (4, "unsupported_syntax")]


def test_template_wraps_unstyled_tokens():
    span = lambda text, flags: {"text": text, "flags": flags}
    lines = [[span("vlan ", 16), span("{ vlan-", 0)], [span("id1 [ ", 0), span("to ", 16), span("vlan-id2 ] } &<1-10>", 0)]]
    assert template(lines) == "vlan { <vlan-id1> [ to <vlan-id2> ] } &<1-10>"


def test_text():
    assert unwrap("a-\n b  c") == "a-b c"
    assert topic_key("Straße  X") == "strasse x"
    assert text_of("<p><b>IPv</b>6</p><script>x</script><p>a<span>pply</span></p>") == "IPv6\napply"


def test_patterns_join(spark):
    calls = spark.createDataFrame([("vlan", "vlan 10"), ("vlan", "vlan"), ("vlan", "VLAN all")], "first string, invocation string")
    templates = spark.createDataFrame([("vlan", "vlan { <id> | all }"), ("vlan", "vlan &<1-999999999999999999999>")], "first string, template string")
    assert {r["invocation"] for r in grammar.invocation_matches(calls, templates, ["first"]).collect()} == {"vlan 10", "VLAN all"}
