import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trendlake.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    count = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def corpus(rng):
    stems = ["".join(rng.choice("aeinrsté×") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    docs = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = stems[int(rng.random() ** 2 * len(stems))]
            if rng.random() < 0.3:
                p = rng.randrange(len(w) + 1)
                w = rng.choice([w[:p] + rng.choice("aeZÿ") + w[p:], w[:p] + w[p + 1:], w[:p] + "e" + w[p + 1:]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        docs.append((i, rng.choice([" ", ", ", "1", "\n"]).join(words)))
    return docs


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("shard_words,depth", [(1 << 16, None), (7, 3), (40, 1)])
def test_equals_brute_force(spark, make_docs, monkeypatch, shard_words, depth):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard_words)
    if depth:
        monkeypatch.setattr(spelling, "depth_for", lambda words: depth)
    docs = corpus(random.Random(5))
    want = brute(docs)
    assert any(v[0] for v in want.values()) and any(v[0] != v[1] for v in want.values() if v[0])
    got = spelling.spelling_forms(make_docs(docs))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == want


def test_odd_rows(spark, make_docs):
    long = "y" * 70_000
    docs = [(1, None), (2, ""), (None, "houses houses houses"), (3, "house House HOUSE HOUSE"), (3, "house " * 4),
            (4, " ".join([long, long + "x", "abcd"] * 3)), (5, "École école " * 3), (6, "город " * 5)]
    docs += [(7, "tieda tiedb tiedc " * 3), (7, "tieda tiedb tiedc " * 3)]
    assert result(spelling.spelling_forms(make_docs(docs))) == brute(docs)
    assert result(spelling.spelling_forms(make_docs([]))) == {}


def test_trie_reaches_all_within_the_budget_and_leaves_are_verified():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (400, len(spelling.GROUPS)))
    counts[:, 5:] = 0
    trie = spelling.CountTrie(counts)
    vectors = spelling.leaves(counts)[0]
    got = {(int(q), int(v)) for qs, vs in trie.search(vectors) for q, v in zip(qs, vs)}
    step = vectors[:, None, :] - vectors[None, :, :]
    fits = (np.maximum(step, 0).sum(axis=2) <= 1) & (np.maximum(-step, 0).sum(axis=2) <= 1)
    assert got == set(zip(*map(lambda x: x.tolist(), np.nonzero(fits))))
    groups = spelling._group_table()
    words = ["abcde", "abcdf", "abcd", "bcdef", "aabcde", "abcde", "a", ""]
    w = spelling.Words.of(pa.array(words), np.ones(len(words), dtype=np.int64), groups)
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    assert spelling.one_edit(w, i, w, j).tolist() == [one_edit(words[a], words[b]) for a, b in zip(i, j)]
