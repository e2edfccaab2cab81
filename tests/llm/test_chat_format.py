"""Chat formatting against hashes of the source, with every kind of conflicting content."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from yearring.llm.chat_format import CHAT, Conflict, Template, format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string, segment string, loss_start long, n_turns int"
PIECES = [*CHAT.controls, "<", "[", "\\", "|", "user", "\n", "", "<\\|im_end|>", "<\\\\s>", "[\\/INST]", "Ä😀", "im_start|>", "s>", "<<\\SYS>>"]


@given(st.lists(st.sampled_from(PIECES), max_size=12), st.lists(st.sampled_from(PIECES), max_size=4))
def test_any_content_comes_back(text, role):
    role, text = "".join(role), "".join(text)
    segment, turn = CHAT.render(role, text)
    assert [(t.role, t.text) for t in CHAT.parse(segment + segment)] == [(role, text)] * 2
    assert CHAT.unescape(segment[turn.start : turn.end]) == text
    assert not any(c in segment[turn.start : turn.end] for c in CHAT.controls)


def test_plain_content_is_not_escaped():
    assert CHAT.render("user", "a < b \\ c [x]")[0] == "<|im_start|>user<|im_sep|>a < b \\ c [x]<|im_end|>"
    assert CHAT.render("user", "<s>")[0] == "<|im_start|>user<|im_sep|><\\s><|im_end|>"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>", "<|im_start|>user<|im_end|>", "<|im_start|>u<|im_sep|>t<|im_end|> "])
def test_the_parser_refuses(bad):
    with pytest.raises(Conflict):
        CHAT.parse(bad)


@pytest.mark.parametrize("marks", [("<a>", "<a>", "<b>"), ("ab", "bc", "<c>"), ("aa", "<b>", "<c>"), ("<abc>", "ab", "<c>"), ("<\\a>", "<b>", "<c>")])
def test_ambiguous_templates_are_refused(marks):
    with pytest.raises(ValueError):
        Template(*marks)


def test_other_template():
    template = Template("{t", "~>", "$;", (), ("bot",))
    segment, turn = template.render("bot", "a~>b$;{tc")
    assert template.parse(segment)[0].text == "a~>b$;{tc"


def test_conversations(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), "".join(rng.choices(PIECES, k=30))) for t in range(3000)]  # one hot conversation
    rows += [(c, t, ["system", "user", "assistant"][t], f"turn {t} " + "".join(rng.choices(PIECES, k=5))) for c in range(20, 60) for t in range(3)]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (61, None, None, "no turn"), (61, 3, "assistant", "")]
    rows += [(62, 1, "assistant", "twice")] * 3 + [(63, 0, "assistant", "<s>" * 100_000 + "x" * 1_000_000)]
    df = spark.createDataFrame([(*r, "clash", 9, 9) for r in rows], SCHEMA).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in read_back(format_conversations(df)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        pairs = [(r[2] or "", r[3] or "") for r in turns]
        loss = "".join(t for r, t in pairs if r == "assistant")
        whole = "".join(CHAT.render(*p)[0] for p in pairs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in pairs), loss)]
        want[conv] = (len(pairs), sha[0], len(loss), sha[1], len(whole))
    assert got == want


def test_empty(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
