import hashlib
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trendlake.llm import byte_bpe

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def replay():
    with open(FILE, "rb") as f:
        return byte_bpe.MergeReplay(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(replay):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=replay.ranks, special_tokens={})


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdeéß' \n\t12!—日本ingtho"), max_size=60), max_size=5))
def test_ids_equal_the_library(replay, library, texts):
    for text, raw in zip(texts, replay.encode(texts)):
        assert ids_of(raw) == library.encode_ordinary(text)
        assert replay.decode(raw) == text.encode()


def test_stepwise_and_joint_replay_agree(replay):
    pieces = [b"aaaaaaa", b"abababab", b"", b"the", b" " * 33, bytes(range(256)), b"in" * 500]
    joint = replay.replay(pieces)
    merged = replay._merge_together
    replay._merge_together = lambda *state: None
    try:
        assert replay.replay(pieces) == joint
    finally:
        replay._merge_together = merged


def test_documents(make_docs, library):
    long = "Überlänge und mehr. " * 20_000 + "z" * 50_000
    rows = [(1, "A first text's end."), (2, None), (3, ""), (4, long), (5, "A first text's end."), (None, "<|endoftext|>")]
    got = byte_bpe.encode_documents(make_docs(rows), FILE, public_tokenizers.PATTERN, with_ids=True).collect()
    want = dict(rows)
    for r in got:
        ids = library.encode_ordinary(want[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((want[r.doc_id] or "").encode()).hexdigest()
    assert len(got) == len(rows)
    assert byte_bpe.encode_documents(make_docs([]), FILE, public_tokenizers.PATTERN).count() == 0


def test_workers_keep_nothing_after_a_task(make_docs, spark):
    rows = [(i, f"piece{i} of text") for i in range(40)]
    byte_bpe.encode_documents(make_docs(rows), FILE, public_tokenizers.PATTERN).collect()

    def kept(batches):
        import gc
        import sys
        for _ in batches:
            pass
        module = sys.modules.get("trendlake.llm.byte_bpe")
        yield pa.RecordBatch.from_pydict(
            {"n": [sum(isinstance(x, module.MergeReplay) for x in gc.get_objects()) if module else 0]})

    idle = spark.range(0, 64, 1, 8).mapInArrow(kept, "n bigint").collect()
    assert [r.n for r in idle] == [0] * 8
