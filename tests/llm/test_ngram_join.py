import random
import re

import numpy as np
import pytest

from trendlake.llm import ngram_join as nj


def shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def brute(docs, words=5, percent=80):
    sets = [shingles(t, words) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if None not in (docs[i][0], docs[j][0]) and both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return sorted(((key, len(sets[i]), low[root(i)] if key is not None else None) for i, (key, _) in enumerate(docs)),
                  key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(rng):
    """Texts without relation, families of near copies around the threshold,
    a passage that a third of all share, and short texts of common parts."""
    word = lambda: "w%d" % rng.randrange(4000)
    passage = [word() for _ in range(60)]
    texts = [[word() for _ in range(rng.randint(0, 120))] for _ in range(60)]
    for t in texts[::3]:
        t[len(t) // 2:len(t) // 2] = passage
    for base in [[word() for _ in range(n)] for n in (12, 40, 90, 200)]:
        texts.append(base)
        for _ in range(25):
            t = list(base)
            for _ in range(rng.randint(0, max(2, len(base) // 25))):
                at = rng.randrange(len(t))
                t[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            texts.append(t)
    for n in range(40):
        texts.append(["Order", str(n), *passage[:rng.randint(20, 34)]])
    texts += [passage[:n] for n in (1, 2, 4, 5, 6, 60)] + [t[:] for t in texts[5:60:5]] * 2
    rng.shuffle(texts)
    return [(i, rng.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words,percent,small", [(5, 80, False), (5, 80, True), (3, 60, True), (5, 100, False)])
def test_equals_brute_force(spark, make_docs, monkeypatch, words, percent, small):
    if small:       # many blocks of a band, frequent shingles, few bits, many parts
        for name, value in (("TILE", 3), ("OFTEN", 4), ("WIDEST", 128), ("PART_BYTES", 500), ("SALTS", 2),
                            ("BLOCK_SHINGLES", 300)):
            monkeypatch.setattr(nj, name, value)
    docs = corpus(random.Random(words + percent))
    want = brute(docs, words, percent)
    if percent < 100:
        assert len({c for _, _, c in want}) < len({tuple(sorted(shingles(t, words))) for _, t in docs}) - 20
    assert result(nj.ngram_components(make_docs(docs), words, percent)) == want


def test_odd_rows(spark, make_docs):
    long = " ".join(f"a{i % 9000} b{i}" for i in range(40_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "One two\nthree four"),
            (8, "École un deux trois quatre"), (9, "école un deux trois quatre"), (None, "one"), (None, None),
            (10, long), (11, long + " end"), (12, "x y z u v w"), (12, "x y z u v w"), (12, "p q r s t u"),
            (13, "p q r s t u")]
    assert result(nj.ngram_components(make_docs(docs))) == brute(docs)
    assert result(nj.ngram_components(make_docs([]))) == []
    assert result(nj.ngram_components(make_docs([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40, 300, 5000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for share in (0.0, 0.05, 0.11, 0.3):
            other = np.unique(np.concatenate([base[rng.random(len(base)) >= share],
                                              rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)]))
            p, q = nj._words([nj.bitmap(base)]), nj._words([nj.bitmap(other)])
            width = min(p.shape[1], q.shape[1])
            differ = int(np.bitwise_count(nj.folded(p, width) ^ nj.folded(q, width)).sum())
            both = nj.overlap(base, other)
            assert both == len(np.intersect1d(base, other)) <= (len(base) + len(other) - differ) // 2
            if both * 100 >= 80 * (len(base) + len(other) - both):
                none = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
                assert set(nj.prefix(base, none, 80).tolist()) & set(nj.prefix(other, none, 80).tolist())
                sides = [(np.array([len(x)]), np.array([k], dtype=object), [nj.bitmap(x)])
                         for k, x in enumerate((base, other))]
                assert [len(x) for x, _ in nj.tile_pairs(*sides, 80)] == [1]
