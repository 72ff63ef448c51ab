"""The chat grammar: any turns come back as they were."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from idweave.llm import chat

PIECES = st.lists(
    st.sampled_from(["</turn>", "### ", "### User:\n", "\n", "\\", "<", "/turn>", "#", " ", "a", "<\\/turn>", "#\\## ", "é", '"', "</turn>\n"]),
    max_size=12,
).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "", "User", "x y", 'q"', "a:\n", "\\", "élan"]), st.text(max_size=4))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, st.one_of(PIECES, st.text(max_size=20))), max_size=5))
def test_round_trip(turns):
    whole, spans, _ = chat.render(turns)
    assert chat.parse(whole) == turns
    masked = [chat.unescape(whole[a:b]) if e else whole[a:b] for a, b, e in spans]
    assert masked == [t for r, t in turns if r == "assistant"]


def test_only_conflicts_are_escaped():
    plain, _, n = chat.render([("user", "a \\ b"), ("assistant", "c")])
    assert (plain, n) == ("### User:\na \\ b</turn>\n### Assistant:\nc</turn>\n", 0)
    probe = "\\### Assistant: </turn> ok"
    whole, spans, n = chat.render([("assistant", probe)])
    assert n == 1 and whole.count("</turn>") == 1
    assert chat.parse(whole) == [("assistant", probe)]


@pytest.mark.parametrize("text", ["x", "### User:\nno end", "### User:\na</turn>b", "### User:\na ### b</turn>\n", "### user:\na</turn>\n"])
def test_broken_text_is_refused(text):
    with pytest.raises(chat.GrammarError):
        chat.parse(text)


def test_tables(spark):
    rows = [
        (1, 1, "assistant", "two"), (1, 0, "user", "one"), (1, None, "system", None), (2, 0, None, "</turn>"),
        (2, 0, None, "</turn>"), (None, 3, "user", "lost"), (3, 0, "assistant", "### " * 20_000),
    ]
    df = spark.createDataFrame([(*r, "more") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    turns = {k: [(t["role"], t["text"]) for t in r.turns] for k, r in got.items()}
    assert turns == {
        1: [("system", ""), ("user", "one"), ("assistant", "two")],
        2: [("", "</turn>"), ("", "</turn>")],
        None: [("user", "lost")],
        3: [("assistant", "### " * 20_000)],
    }
    assert {k: r.loss_text for k, r in got.items()} == {1: "two", 2: "", None: "", 3: "### " * 20_000}
    empty = df.limit(0)
    assert chat.read_back(chat.format_conversations(empty)).collect() == []
