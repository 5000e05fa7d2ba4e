import collections
import math

import pytest

from trendlake.llm import mixing


def sources(n_by):
    rows, i = [], 0
    for source, n in n_by.items():
        for _ in range(n):
            rows.append((i, "w " * (3 + i % 5), source))
            i += 1
    return rows


def spent(mixed):
    out = collections.Counter()
    for r in mixed.select("mix_.*").collect():
        out[r.source] += r.n_tokens
    return out


def test_repetition_limit_is_met_and_every_document_comes(make_docs):
    rows = sources({"big": 700, "mid": 150, "small": 30})
    df = make_docs(rows)
    mixed = mixing.mix(df, mixing.Mixture(repetition_limit=2.0))
    assert mixed.columns == df.columns + ["mix_"]       # "mix" was taken
    total = collections.Counter()
    for _, text, source in rows:
        total[source] += len(text.split())
    epochs = {s: n / total[s] for s, n in spent(mixed).items()}
    assert abs(epochs["big"] - 1) < 1e-9 and 1.97 <= epochs["small"] <= 2.0 and 1 < epochs["mid"] < 2
    seen = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(seen) == {r[0] for r in rows} and max(seen.values()) <= 2


def test_budget_is_never_exceeded_and_blocks_are_permuted(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    rows = sources({"a": 800, "b": 300})
    mixed = mixing.mix(make_docs(rows), mixing.Mixture(repetition_limit=1.3, budget_tokens=2500))
    got = spent(mixed)
    assert sum(got.values()) <= 2500 and sum(got.values()) > 2500 - 2 * 8
    ranks = {(r.source, r.epoch, r.block): r.block_rank for r in mixed.select("mix_.*").collect()}
    assert len({k[2] for k in ranks if k[0] == "a"}) > 5
    by_epoch = collections.defaultdict(list)
    for (s, e, _), rank in ranks.items():
        by_epoch[s, e].append(rank)
    assert all(sorted(v) == list(range(len(v))) for v in by_epoch.values())


def test_exponent_by_plain_bisection(spark):
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "src string, share double")
    p = [0.7, 0.2, 0.1]

    def entropy(a):
        z = sum(x ** a for x in p)
        return -sum(x ** a / z * math.log(x ** a / z) for x in p)
    low, high = 0.0, 1.0
    for _ in range(40):
        m = (low + high) / 2
        low, high = (m, high) if entropy(m) >= 0.95 else (low, m)
    got = mixing.bisect_exponent(shares, 10, mixing.Mixture(target_entropy=0.95))
    assert got == pytest.approx(low, abs=1e-9)
    assert mixing.bisect_exponent(shares, 10, mixing.Mixture(target_entropy=9.0)) == 0.0
    assert mixing.bisect_exponent(shares, 10, mixing.Mixture(target_entropy=0.01)) == 1.0
    low, high = 0.0, 1.0
    for _ in range(40):
        m = (low + high) / 2
        low, high = (low, m) if (0.1 ** m / 0.1) / (0.7 ** m / 0.7) <= 3 else (m, high)
    assert mixing.bisect_exponent(shares, 10, mixing.Mixture(repetition_limit=3.0)) == high
    assert mixing.bisect_exponent(shares, 10, mixing.Mixture(repetition_limit=1.0)) == 1.0
    assert mixing.bisect_exponent(shares, 10, mixing.Mixture(repetition_limit=99.0)) == 0.0


def test_nulls_empty_texts_repeats_and_empty_table(make_docs):
    rows = [(1, None, None), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", None), (5, "", "none")]
    got = collections.Counter(r.doc_id for r in mixing.mix(make_docs(rows), mixing.Mixture()).collect())
    assert got[3] >= 2 and got[5] == 1 and got[1] >= 1 and got[None] >= 1 and got[2] >= 1
    assert mixing.mix(make_docs([])).count() == 0
