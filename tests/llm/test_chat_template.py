"""Template compiler, streaming format and read-back (the table check is in
test_url_filter, with the other SQL)."""

import random

import pytest

from livetable.llm import chat_template as c

from conftest import sha


def render(source, **scope):
    return "".join(p for p, _ in c.compile_template(source)(scope))


def test_language():
    assert render("a{{ 1 }}{{ 'x' ~ n }}{# gone #}b", n=3) == "a1x3b"
    assert render("{% if a == 'x' and not b %}1{% elif a != 'y' or b %}2{% else %}3{% endif %}", a="y", b=None) == "3"
    assert render("{% for m in ms %}{{ loop.index }}{{ m.t | upper | trim }}{% endfor %}", ms=[{"t": " a"}, {"t": "b "}]) == "1A2B"
    assert render("{{ none }}{{ missing.deep }}") == ""
    assert render(r"{{ 'it\'s' }}") == "it's"


def test_sandbox():
    class Secret:
        value = "no"
    assert render("{{ s.value }}{{ s.__class__ }}", s=Secret()) == ""
    for bad in ("{{ a.b( }}", "{{ open('x') }}", "{% include 'x' %}", "{{ a | exec }}", "{% if a %}", "{% for x y %}{% endfor %}", "{{ 1 ^ 2 }}"):
        with pytest.raises(c.TemplateError):
            c.compile_template(bad)


def test_constants_are_folded():
    tree = c.fold(c.parse("a{{ 'b' ~ 1 }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{{ 'd' | upper }}{{ x }}{% if 'u' == 'v' %}no{% endif %}"))
    assert tree == [("text", "ab1cD"), ("out", ("name", "x"))]
    assert c.fold(c.parse("{{ true and x }}{{ false or x }}")) == [("out", ("name", "x"))] * 2


def test_generation_marks():
    pieces = list(c.compile_template("q{% generation %}{{ a }}{% if a %}!{% endif %}{% endgeneration %}z")({"a": "x"}))
    assert [p for p, learnt in pieces if learnt] == ["x", "!"] and "".join(p for p, _ in pieces) == "qx!z"


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or "")))
        turns = [(role or "", text or "") for _, _, role, text in turns]
        loss = "".join(t for role, t in turns if role == "assistant")
        size = 3 + sum(len(c.escape(t)) + (13 if role == "user" else 9 if role == "assistant" else 19 + len(c.escape(role))) for role, t in turns)
        out[conv] = (len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)), len(loss), sha(loss), size)
    return out


@pytest.mark.parametrize("part_chars", [c.PART_CHARS, 50])
def test_read_back_is_exact(spark, monkeypatch, part_chars):
    monkeypatch.setattr(c, "PART_CHARS", part_chars)
    rng = random.Random(5)
    bits = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "[ROLE]", "[SAYS]", "é", "😀", "\n", " ok ", "[ANS]", "\\[", "\r"]
    rows = [(k % 7, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "", "user", "assistant", "system", "[x]<\\"]),
             rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))])) for k in range(120)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b" * 3000), (99, 0, "assistant", "x" * 100_000)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as last")
    got = {r["conv_id"]: tuple(r)[1:] for r in c.read_back(c.format_conversations(df)).collect()}
    assert got == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.read_back(c.format_conversations(df)).collect() == []
