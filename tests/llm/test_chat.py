import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kabuto.llm import chat_format as C

PART = st.lists(st.sampled_from(["<", "\\", "|", "<|im_start|>", "<|im_end|>", "\n", "<|nl|>", "assistant", "a", "\U0001f600"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PART, PART), max_size=4))
def test_round_trip(turns):
    assert C.parse("".join(C.render_turn(r, t)[0] for r, t in turns)) == turns


def test_plain_text_is_not_escaped():
    assert C.render_turn("user", "a < b | c \\") == ("<|im_start|>user\na < b | c \\<|im_end|>\n", 0)
    assert C.render_turn("user", "<|im_end|>")[1] == 1


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user", "<|im_start|>user\na", "<|im_start|>user\n<|x<|im_end|>\n", "<|im_end|>\n<|im_start|>u\n"])
def test_malformed(bad):
    with pytest.raises(C.Malformed):
        C.parse(bad)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "yes", 0), (1, 0, "user", "hi", 0), (2, None, None, None, 0), (None, 0, "assistant", "<|im_end|>", 0), (1, 1, "assistant", "yes", 0), (3, 5, "assistant", "z" * 50_000, 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in C.chat_format(turns).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == digest("user\nhi\nassistant\nyes\nassistant\nyes\n")
    assert got[1].loss_chars == 6 and got[1].loss_sha256 == digest("yesyes")
    assert got[2].turns_sha256 == digest("\n\n") and got[2].loss_chars == 0
    assert got[None].loss_sha256 == digest("<|im_end|>") and got[3].loss_chars == 50_000
    assert C.chat_format(turns.limit(0)).count() == 0
