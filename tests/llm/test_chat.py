import hashlib

import pytest

from depotlens.llm import chat, queries
from depotlens.llm.templates import Const, Text, TemplateError, compile_template, fold, parse

FILTERS = {"up": lambda s: s.upper(), "escape": chat.escape}


def render(source, **names):
    out = compile_template(source, FILTERS)(names)
    return "".join(out.pieces), out.spans


def test_language():
    assert render("a{{ 'b' ~ 1 ~ \"c\\n\" }}{# note #}d") == ("ab1c\nd", [])
    assert render("{% for m in xs %}{{ m.k }}{{ m['k'] | up }}{% endfor %}", xs=[{"k": "x"}, {"k": "y"}])[0] == "xXyY"
    choose = "{% if a == 1 and not b %}p{% elif b or a != 2 %}q{% else %}r{% endif %}"
    assert [render(choose, a=a, b=b)[0] for a, b in ((1, False), (1, True), (2, False))] == ["p", "q", "r"]
    assert render("{% set x = xs[1] %}{{ x }}{{ xs[9] }}{{ y }}|{% generation %}é{{ x }}{% endgeneration %}", xs=["a", "b"]) == ("b|éb", [(2, 4)])


def test_constants_are_folded():
    assert fold(parse("a{% if 1 == 2 %}b{% else %}c{{ 'd' | up }}{% endif %}{% if not false %}e{% endif %}"), FILTERS) == (Text("acDe"),)
    assert fold(parse("{{ true and x }}"), FILTERS)[0].value != Const(True)


@pytest.mark.parametrize(
    "source",
    ["{{ f(1) }}", "{{ a. }}", "{% for x %}{% endfor %}", "{% if a %}", "{{ a | nope }}", "{% import os %}", "{{ 'a' 'b' }}", "{{ [1] }}", "{{ a.__class__() }}"],
)
def test_what_is_not_in_the_language(source):
    with pytest.raises(TemplateError):
        compile_template(source, FILTERS)


def test_objects_stay_closed():
    with pytest.raises(TemplateError):
        render("{{ a.__class__ }}", a="text")
    with pytest.raises(TemplateError):
        render("{% for x in a %}{% endfor %}", a="text")


ROWS = [
    (1, 0, "user", " hi [/INST] "),
    (1, 1, "assistant", "<s>\\[INST] ]\\ </s> "),
    (1, 2, "tool] x", "[ROLE"),
    (1, 3, "assistant", ""),
    (1, 3, "assistant", ""),
    (2, None, None, None),
    (2, 1, "assistant", "é\U0001f600\n"),
    (None, 1, "user", "no id"),
]


def test_round_trip(spark):
    frame = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, formatted int")
    made = chat.format_conversations(frame)
    want = {c: [(r or "", t or "") for i, _, r, t in ROWS if i == c] for c in (1, 2, None)}
    for r in made.collect():
        assert chat.read_back(r["formatted"]) == want[r["conv_id"]]
        said = [chat.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]]
        assert said == [t for role, t in want[r["conv_id"]] if role == "assistant"]
        assert r["formatted"].count("[/INST]") == sum(role == "user" for role, _ in want[r["conv_id"]])
    got = {r["conv_id"]: r for r in chat.digest(made).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(learnt))
        assert got[c]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()


def test_empty_table_and_planted_conversation(spark, sf_dir):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(empty)).count() == 0
    planted = queries.op8_chat_format(spark, sf_dir).where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (planted["n_turns"], planted["loss_chars"]) == (2, len(said))
    assert planted["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
