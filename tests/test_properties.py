"""Property tests on random mention sets (Hypothesis, few examples: each
example is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendlake.operators import grid
from trendlake.operators.features import lag_features, scoring_rows

LABELS = ["ORG", "PERSON", "DATE", "CARDINAL"]
BASE = dt.date(2025, 8, 1)

mention = st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.sampled_from(LABELS),
                    st.one_of(st.none(), st.integers(0, 20)))
mentions_st = st.lists(mention, min_size=1, max_size=60)
FAST = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    data = [(e, t, None if d is None else BASE + dt.timedelta(days=d)) for e, t, d in rows]
    return spark.createDataFrame(data, "entity_text string, entity_type string, published_date date")


@FAST
@given(rows=mentions_st, lo=st.integers(0, 10), span=st.integers(0, 12))
def test_grid_size_and_sum(spark, rows, lo, span):
    m = _df(spark, rows)
    dates = m.select(F.col("published_date").alias("the_date")).distinct()
    lo_d, hi_d = BASE + dt.timedelta(days=lo), BASE + dt.timedelta(days=lo + span)
    g = grid.dense_daily_counts(m, dates, lo_d, hi_d, allowed=("ORG", "PERSON")).collect()
    ents = {e for e, t, _ in rows if t in ("ORG", "PERSON")}
    days = {d for _, _, d in rows if d is not None and lo <= d <= lo + span}
    assert len(g) == len(ents) * len(days)
    assert len({(r[0], r[1]) for r in g}) == len(g)
    want = sum(1 for e, _, d in rows if e in ents and d is not None and lo <= d <= lo + span)
    assert sum(r[2] for r in g) == want


@FAST
@given(counts=st.lists(st.lists(st.integers(0, 9), min_size=6, max_size=12), min_size=1, max_size=4))
def test_lags_and_scoring(spark, counts):
    n = min(len(c) for c in counts)
    rows = [(f"e{i}", BASE + dt.timedelta(days=j), c[j]) for i, c in enumerate(counts) for j in range(n)]
    g = spark.createDataFrame(rows, "entity_text string, published_date date, count_mentions long")
    f = lag_features(g).collect()
    assert len(f) == len(counts) * (n - 5)
    series = {f"e{i}": c[:n] for i, c in enumerate(counts)}
    for r in f:
        t = (r.published_date - BASE).days
        assert r.target == series[r.group_id][t]
        for k in range(1, 6):
            assert r[f"lag_{k}"] == series[r.group_id][t - k]
    assert sorted({r.group_id_enc for r in f}) == list(range(len(counts)))
    s = scoring_rows(lag_features(g)).collect()
    assert len(s) == len(counts)
    for r in s:
        assert [r[f"lag_{k}"] for k in range(1, 6)] == series[r.group_id][::-1][:5]
        assert r.date == BASE + dt.timedelta(days=n)
