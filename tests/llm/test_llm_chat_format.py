import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclograph.llm import chat_format as cf

PIECES = st.lists(st.sampled_from(["\\", "###", "#", "</turn>", "</role>", "### User: ", "\n", "</tur", " ", "é", "ok"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PIECES), PIECES), max_size=5))
def test_any_turns_come_back(turns):
    blocks = [cf.render_turn(role, text) for role, text in turns]
    back = cf.parse("".join(b[0] for b in blocks))
    assert [(t.role, t.text) for t in back] == turns
    assert [cf.unescape(b[start:end]) for b, start, end in blocks] == [text for _, text in turns]


def test_only_conflicting_text_is_escaped():
    assert cf.render_turn("user", "a \\ b # c")[0] == "### User: a \\ b # c</turn>\n"
    assert cf.render_turn("user", "a ### b")[0] == "### User: a \\### b</turn>\n"
    assert cf.render_turn("user", "\\### </turn>")[0] == "### User: \\\\\\### \\</turn></turn>\n"


@pytest.mark.parametrize("text", ["### User: a", "x", "### User: a ### b</turn>\n", "### User: a</turn>", "### Nobody: a</turn>\n"])
def test_bad_grammar_raises(text):
    with pytest.raises(ValueError):
        cf.parse(text)


def brute(turns):
    ordered = sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
    loss = "".join(t[3] or "" for t in ordered if t[2] == "assistant")
    whole = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in ordered)
    chars = sum(len(cf.render_turn(t[2] or "", t[3] or "")[0]) for t in ordered)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (turns[0][0], len(turns), sha(whole), len(loss), sha(loss), chars)


def test_conversations(spark, monkeypatch):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "user", "### </turn> \\"),
        (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "user", "same"), (3, 0, "user", "same"),
        (4, 0, "tool </role>: x", "\\"), (5, 0, "assistant", "long \\### " * 30_000), (5, 1, "assistant", ""),
    ]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, part int, formatted string")
    monkeypatch.setattr(cf, "PART_CHARS", 1000)
    formatted = cf.format_conversations(df)
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    expected = sorted((brute(g) for g in groups.values()), key=repr)
    assert sorted((tuple(r) for r in cf.read_back(formatted, in_order=True).collect()), key=repr) == expected
    assert sorted((tuple(r) for r in cf.read_back(formatted.orderBy("formatted")).collect()), key=repr) == expected
    assert formatted.filter("conv_id = 5").count() == 2


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert cf.read_back(cf.format_conversations(df)).count() == 0
