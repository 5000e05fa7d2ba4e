import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.llm import hard_negatives as hn


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    whole = [(i, str(c), [int(np.floor(scale * float(v))) for v in x]) for i, c, x in rows]
    out = []
    for i, c, x in whole:
        if not anchor(i):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), j, d) for j, d, y in whole if j != i)
        for s, j, _ in [t for t in scored if t[2] == c][:positives]:
            inside = [t for t in scored if t[2] != c and low * -s <= 100 * -t[0] <= high * -s][:negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(inside, 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                       "negative_score").collect()))


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, c, [float(v) for v in x], "x", 1) for i, c, x in rows],
                                 f"vec_id bigint, label int, embedding array<{kind}>, Q string, shard int")


def mixed(rng, n=700, dim=12):
    """Rows in tight groups, rows without structure, and ties; norms differ."""
    centres = rng.normal(size=(6, dim))
    x = np.where(rng.random((n, 1)) < 0.6, centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.05,
                 rng.normal(size=(n, dim)))
    x *= rng.uniform(0.3, 3, (n, 1))
    x[n // 2:n // 2 + 100] = x[n // 2]
    return [(i, int(rng.integers(0, 4)), x[i].astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:       # two laid-out levels, several blocks of a shard, several slices of its anchors
        for name, value in (("BLOCK_ROWS", 20), ("PROBE_ROWS", 3), ("FAN", 4), ("LEAF", 8), ("TOGETHER", 2)):
            monkeypatch.setattr(hn, name, value)
    rows = mixed(np.random.default_rng(2))
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 1000
    assert result(hn.hard_negatives(table(spark, rows, "float"), F.col("id") % 10 == 0)) == want


def test_settings_and_unbounded_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, (rng.normal(size=4) * 10.0 ** (i % 14)).tolist()) for i in range(200)]
    want = brute(rows, lambda i: i < 20, positives=2, negatives=3, low=10, high=120)
    cut = [(*r[:4], *(max(-2 ** 63, min(2 ** 63 - 1, v)) for v in r[4:])) for r in want]
    got = result(hn.hard_negatives(table(spark, rows), F.col("id") < 20, positives=2, negatives=3, low=10, high=120))
    assert got == sorted(cut) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 2, [1.0, i / 50]) for i in range(40)]
    odd = [(100, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (101, 1, None), (102, 1, [nan, 1.0]), (103, 1, [inf, 1.0]),
           (104, 0, [1.0, None]), (105, 0, [1e300, 1.0]), (99, 0, [2.0 ** 50, 1.0])]
    kept = [(106, 0, []), (107, 1, [0.9]), (108, 0, [0.9, 0.5, 4.0]), (109, 1, [0.0, 0.0, 0.0])]
    repeated = [(7, 1, [1.0, 7 / 50]), (8, 1, [9.0, 9.0])]      # 8 with label 0 stays
    schema = "vec_id bigint, label int, embedding array<double>, id string"
    df = spark.createDataFrame([(*r, "x") for r in rows + odd + kept + repeated], schema)
    want = brute(rows + kept, lambda i: i % 4 == 0)
    assert want and result(hn.hard_negatives(df, F.col("id") % 4 == 0)) == want
    assert result(hn.hard_negatives(df.limit(0), F.col("id") % 4 == 0)) == []
    assert result(hn.hard_negatives(df.where("label = 0"), F.col("id") % 4 == 0)) == []


def test_tree_excludes_far_groups_and_loses_nothing():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 40
    x = np.round(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)))
    tree, leaves = hn.grow(x, 64)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(4000)) and max(map(len, leaves)) <= 64
    a, norms = x[:50], hn._norms(x[:50])
    scores = a @ x.T
    lo, hi = np.sort(scores, axis=1)[:, -40] - 0.0, scores.max(axis=1)
    visited = np.zeros((50, len(leaves)), dtype=bool)

    def walk(node, some):
        if not isinstance(node, hn.Node):
            visited[some, node] = True
        elif len(some):
            reach = node.reachable(a[some], norms[some], np.arange(len(some)), lo[some], hi[some])
            for j, child in enumerate(node.children):
                walk(child, some[reach[:, j]])

    walk(tree, np.arange(50))
    share = np.mean([sum(len(leaves[j]) for j in np.flatnonzero(v)) / 4000 for v in visited])
    assert share < 0.4
    for i in range(50):
        reached = set(np.concatenate([leaves[j] for j in np.flatnonzero(visited[i])]).tolist())
        assert set(np.flatnonzero((scores[i] >= lo[i]) & (scores[i] <= hi[i])).tolist()) <= reached
