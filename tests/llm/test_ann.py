import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from trendlake.llm import ann
from trendlake.llm.common import table


def exact(rows, is_query, k):
    out = {}
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    ids = np.array([r[0] for r in rows])
    for i in np.flatnonzero([is_query(v) for v in ids]):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall_against_brute_force(spark, unit):
    given = table(spark, SF01, "embeddings")
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in given.collect()]
    if not unit:
        rows = [(i, [v * (1 + i % 5) for v in x]) for i, x in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = result(ann.nearest_neighbours(df, F.col("id") % 20 == 0))
    want = exact(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    by = {q: dict(v) for q, v in want.items()}
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(by[q][i] - s) < 1e-9 for i, s in found if i in by[q])


def test_ties_copies_and_unfit_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(60 + i, [0.0, 1.0]) for i in range(3)]
    rows += [(100, None), (101, [0.0, 0.0]), (102, [nan, 1.0]), (103, [None, 1.0]), (104, [inf, 1.0]),
             (105, []), (106, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (40, [1.0, 0.0])]
    df = spark.createDataFrame([(i, x, "c") for i, x in rows], "vec_id bigint, embedding array<float>, score string")
    got = result(ann.nearest_neighbours(df, F.col("id") % 20 == 0, k=5, success=0.999999))
    assert got.keys() == {0, 20, 40, 60}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[40]] == [0, 1, 2, 3, 4]
    assert got[60] == [(61, 1.0), (62, 1.0), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert ann.nearest_neighbours(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_few_candidates_are_all_returned_and_parts_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = result(ann.nearest_neighbours(df, F.col("id") == 0, k=20, success=0.9999999))
    want = exact(rows, lambda i: i == 0, 20)
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]] and len(got[0]) == 11


def test_probe_order_is_by_probability():
    t = ann.make_tables(8, 1, 3, 1.2, 0)
    p = np.array([0.3, -1.0, 2.0])
    few, many = ann.probe_order(t, 0, p, 0.5, 0.3), ann.probe_order(t, 0, p, 0.5, 0.9)
    assert list(many[:len(few)]) == list(few) and len(many) > len(few)


def test_recall_of_queries_outside_of_dense_groups(spark):
    rng = np.random.default_rng(4)
    n, d = 6000, 32
    centres = rng.normal(size=(30, d))
    x = centres[rng.integers(0, 30, n)] + 0.1 * rng.normal(size=(n, d))
    loose = np.arange(n) % 5 == 0             # a fifth has no group
    x[loose] = rng.normal(size=(loose.sum(), d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = result(ann.nearest_neighbours(df, F.col("id") % 12 == 0))
    want = exact(rows, lambda i: i % 12 == 0, 20)
    recall = {q: len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want}
    for sparse in (False, True):
        some = [recall[q] for q in want if loose[q] == sparse]
        assert len(some) >= 100 and np.mean(some) >= 0.9, (sparse, np.mean(some))
        assert np.mean(np.array(some) < 0.5) <= 0.02
