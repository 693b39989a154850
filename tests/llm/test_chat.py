"""Templates: what they render, what they refuse, and exact round trips of whole tables."""

import hashlib
import random

import pytest

from crawlspark.llm import chat
from crawlspark.llm.chat import INSTRUCT, ChatFormat, Constant, Template, TemplateError

ROWS = "turn bigint, conv_id bigint, text string, role string, piece string, part int"
PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "<|assistant|>", "<|role|>", "<|text|>", "\\", "<", "[", "/", "s>", "<|", "é", "\n", "𝔘 ", ""]


@pytest.mark.parametrize("source, expected", [
    ("a{% for m in messages %}{{ m.text }}{% endfor %}b", "axyb"),
    ("{% for m in messages %}{{ m.role + ':' + m.text | upper }};{% endfor %}", "user:X;assistant:Y;"),
    ("{% for m in messages %}{% if m.role == 'user' and not m.text == 'q' %}U{% elif m.role in 'assistant' %}A{% else %}O{% endif %}"
     "{% endfor %}", "UA"),
    ("{{- 'a' -}}  {# note #} {% for m in messages %} {%- if (1 + 2 == 3 or x) -%} {{ m.text | length }} {%- endif -%} {% endfor %}", "a 11"),
    ("{{ bos }}{{ none }}{{ 3 }}{{ \"q\\\"\\n\" | trim }}{% for m in messages %}{% if true != false %}.{% endif %}{% endfor %}", "<s>3q\"..")])
def test_templates(source, expected):
    assert Template(source, {"bos": "<s>", "x": 0}).render([("user", "x"), ("assistant", "y")]).text == expected


@pytest.mark.parametrize("source", [
    "no loop", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{% for m in range %}{% endfor %}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m }}{% endfor %}",
    "{% for m in messages %}{{ open('x') }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}",
    "{% for m in messages %}", "{% for m in messages %}{% endfor %}{% if 1 %}", "{% for m in messages %}{{ 'a' 'b' }}{% endfor %}",
    "{% import os %}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ m.text }{% endfor %}", "{{ m.text }}",
    "{% generation %}{% for m in messages %}{% endfor %}{% endgeneration %}", "{% for m in messages %}{{ (1 }}{% endfor %}",
    "{% for m in messages %}{{ }}{% endfor %}", "{% for m in messages %}{{ m.text @ 1 }}{% endfor %}"])
def test_everything_else_is_refused(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_constants_are_folded():
    nodes = Template("a{{ 'b' + bos }}{% if 1 == 2 %}no{% else %}c{% endif %}{% for m in messages %}"
                     "{% if 'x' in 'xy' %}{{ 'q' | upper }}{% endif %}{{ m.text }}{% endfor %}", {"bos": "<s>"}).nodes
    assert nodes[0] == Constant("ab<s>c") and nodes[1].body == (Constant("Q"), chat.Field("text")) and len(nodes) == 2


def test_generation_spans_count_code_points():
    piece = INSTRUCT.compiled().render([("user", "é"), ("assistant", "𝔘</s>"), ("tool", "x"), ("assistant", "")])
    assert [INSTRUCT.unescape(piece.text[start:end]) for start, end in piece.spans] == ["𝔘</s>", ""]


def test_texts_of_control_strings_survive():
    dice = random.Random(12)
    template = INSTRUCT.compiled()
    for _ in range(3000):
        said = [(dice.choice(["user", "assistant", "system", "", "</s>"]), "".join(dice.choices(PARTS, k=dice.randrange(9))))
                for _ in range(dice.randrange(5))]
        piece = template.render(said)
        assert piece.text.startswith("<s>") and INSTRUCT.read_turns(piece.text[3:]) == (said, "")
        assert [INSTRUCT.unescape(piece.text[a:b]) for a, b in piece.spans] == [text for role, text in said if role == "assistant"]


def test_control_strings_that_cannot_be_told_apart_are_refused():
    with pytest.raises(TemplateError):
        ChatFormat("{% for m in messages %}{% endfor %}", {}, ("<a<b>",), ())


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(5)
    found = [(turn, conv, "".join(dice.choices(PARTS, k=dice.randrange(12))) * (4000 if conv == 3 else 1),
              dice.choice(["user", "assistant", "system", None]), "x", 9)
             for conv in range(40) for turn in range(dice.randrange(1, 9))]
    found += [(None, 1, "null turn", "user", None, None), (2, None, None, None, None, None), (1, None, "b", "assistant", None, None)]
    found += [(0, 41, None, "assistant", None, None), (0, 42, "same", "user", None, None), (0, 42, "same", "user", None, None)]
    # A third of all rows belong to one conversation.
    found += [(turn, 99, f"turn {turn} </s>", ("user", "assistant")[turn % 2], None, None) for turn in range(150)]
    return spark.createDataFrame(found, ROWS)


def test_read_back_equals_what_was_said(rows):
    said = {}
    for row in sorted(rows.collect(), key=lambda row: (row.turn is not None, row.turn or 0, row.role or "")):
        said.setdefault(row.conv_id, []).append((row.role or "", row.text or ""))
    found = {row.conv_id: row for row in chat.read_back(chat.formatted(rows)).collect()}
    assert set(found) == set(said)
    template = INSTRUCT.compiled()
    for conv_id, turns in said.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert tuple(found[conv_id])[1:] == (
            len(turns), hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), template.render(turns).size)


def test_pieces_in_order_are_the_rendered_conversation(rows):
    pieces = chat.formatted(rows.where("conv_id = 5")).sort(*chat.ORDER).collect()
    turns = [(row.role or "", row.text) for row in rows.where("conv_id = 5").sort("turn").collect()]
    assert "".join(row.piece for row in pieces) == INSTRUCT.compiled().render(turns).text


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(spark.createDataFrame([], ROWS))).collect() == []
