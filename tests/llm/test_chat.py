import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trendlake.llm import chat

PIECES = st.sampled_from([*chat.CONTROL, "\\", "\n", "<", "[", "s>", "INST]", "é😀", "a", "\\\\", "|image|>"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(PIECES, max_size=4).map("".join), st.lists(PIECES, max_size=12).map("".join)), max_size=4))
def test_turns_survive_the_round_trip(turns):
    turns += [("assistant", "</s>[INST] ok [/INST]")]
    text = "".join(chat.format_turn(role, chat.escape(body)) for role, body in turns)
    assert chat.parse_turns(text) == turns
    for _, body in turns:
        assert not any(c in chat.escape(body) for c in chat.CONTROL)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learned = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[conv] = (len(mine), hashlib.sha256(every.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_read_back_against_brute_force(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "system", None), (2, 1, None, "x\ny"),
            (3, 5, "assistant", "<s>\\[/INST] é"), (None, None, "user", "q"), (4, 0, "assistant", "long " * 100_000),
            *[(9, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = chat.read_back(chat.format_turns(df)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_equal_turns_are_ordered_by_their_text(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (r,) = chat.read_back(chat.format_turns(df)).collect()
    assert r.turns_sha256 == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()


def test_parts_become_placeholders(spark):
    part = lambda kind, **x: {"type": kind, "text": None, "ref": None, "width": None, "height": None,
                              "seconds": None, "pages": None, **x}
    turn = [part("text", text="see <|image|>"), part("image", ref="a.png", width=28, height=15),
            part("audio", ref="b.wav", seconds=1.5), part("document", ref="c.pdf", pages=2), part("text", text="end")]
    df = spark.createDataFrame([(1, 0, "assistant", turn), (1, 1, "user", None)],
                               f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    a, b = sorted(chat.format_turns(df, parts_col="parts").collect(), key=lambda r: r.turn)
    assert a.formatted == "<s>assistant\nsee <\\|image|><|image|><|audio|><|document|>end</s>\n"
    assert a.formatted[a.loss_start:a.loss_start + a.loss_chars].endswith("<|document|>end")
    assert [(x.kind, x.ref, x.tokens) for x in a.attachments] == [
        ("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 1024)]
    assert a.expanded_tokens == 2 + 4 + 38 + 1024 + 1 and b.formatted == "[INST]user\n[/INST]\n"
    bad = spark.createDataFrame([(1, 0, "user", [part("video")])], df.schema)
    with pytest.raises(Exception, match="unknown part type"):
        chat.format_turns(bad, parts_col="parts").collect()
