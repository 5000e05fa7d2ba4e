"""The histogram booster against a plain version over all rows at once, and its
check on unseen days against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.operators import boosting, forecast
from trendlake.operators.features import FEATURE_COLS, lag_features, scoring_rows
from trendlake.session import shared_path

START = dt.date(2025, 8, 4)
S = boosting.Settings(rounds=25, bins=16)


def series(rng, entities=30, days=40):
    return [(f"e{i:02d}", START + dt.timedelta(days=d),
             int(rng.poisson((i % 3 + 1) * (9 if d % 7 in (0, 3) else 1)) + (i == 7) * 50))
            for i in range(entities) for d in range(days)]


@pytest.fixture(scope="module")
def feats(spark):
    grid = spark.createDataFrame(series(np.random.default_rng(1)), "entity_text string, published_date date, count_mentions long")
    return forecast.stored_features(grid)


class Plain:
    """One tree after the other, node by node, over plain arrays."""

    def __init__(self, rows, keys, s):
        self.s, x, y = s, rows[:, :-1], rows[:, -1]
        self.cuts = []
        for f in range(x.shape[1]):
            values = np.sort(x[:, f])
            distinct = np.unique(values)
            self.cuts.append(distinct[1:] if len(distinct) <= s.bins else
                             np.unique([values[len(values) * k // s.bins] for k in range(1, s.bins)]))
        self.base, self.trees = y.mean(), []
        # the gradients' fixed point: a power of two, as the booster documents
        reach = int(np.ceil(np.log2(2 * (y.max() - y.min()) + 2)))
        scale = 2.0 ** min(30, 52 - reach - 17, 61 - reach - len(y).bit_length())
        pred = np.full(len(y), self.base)
        for r in range(s.rounds):
            columns = np.sort(np.random.default_rng([s.seed, r]).choice(x.shape[1], int(s.columns * x.shape[1]), replace=False))
            taken = boosting._sampled(keys, s.rows, s.seed, r)
            g = np.rint((pred - y) * scale)
            tree = self.grow(x[taken], g[taken], scale, columns, 0)
            self.trees.append(tree)
            pred = pred + self.answer(tree, x)

    def grow(self, x, g, scale, columns, level):
        value = -self.s.rate * (g.sum() / scale) / (len(g) + self.s.l2)
        best = (boosting.LEAST_GAIN, None)
        if level < self.s.depth:
            whole = (g.sum() / scale) ** 2 / (len(g) + self.s.l2)
            for f in columns:
                for c in self.cuts[f]:
                    left = x[:, f] < c
                    n = left.sum()
                    if 0 < n < len(g):
                        gl = g[left].sum()
                        gain = ((gl / scale) ** 2 / (n + self.s.l2) + ((g.sum() - gl) / scale) ** 2 / (len(g) - n + self.s.l2)
                                - whole)
                        if gain > best[0]:
                            best = (gain, (f, c))
        if best[1] is None:
            return value
        f, c = best[1]
        left = x[:, f] < c
        return f, c, self.grow(x[left], g[left], scale, columns, level + 1), self.grow(x[~left], g[~left], scale, columns, level + 1)

    def answer(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, c, low, high = tree
        return np.where(x[:, f] < c, self.answer(low, x), self.answer(high, x))

    def predict(self, x):
        return self.base + sum(self.answer(t, x) for t in self.trees)


def plain(feats, s, last=None):
    rows = feats.select(*FEATURE_COLS, "target", "published_date", F.xxhash64("group_id", "published_date").alias("k")).collect()
    rows = [r for r in rows if last is None or r.published_date <= last]
    return Plain(np.array([r[:9] for r in rows], dtype=float), np.array([r.k for r in rows], dtype=np.int64), s)


def test_equals_the_plain_version(spark, feats):
    model = boosting.fit(feats, S)[0]
    rows = scoring_rows(feats).orderBy("group_id").collect()
    x = np.array([[float(r[c]) for c in FEATURE_COLS] for r in rows])
    want = plain(feats, S).predict(x)
    assert np.allclose(model.predict(x), want, rtol=0, atol=1e-9)
    got = {r.group_id: r.predicted_count for r in forecast.score_next_day(model, feats).collect()}
    assert got == {r.group_id: max(0, round(p)) for r, p in zip(rows, want)}
    assert len(set(got.values())) >= 3


def test_same_model_on_any_partitioning_and_read_back(spark, feats):
    def nodes(m):
        return [(t.feature.tolist(), t.bin.tolist(), t.value.tolist()) for t in m.trees]

    a = boosting.fit(feats, S)[0]
    for n in (1, 5):
        assert nodes(boosting.fit(feats.repartition(n, "dayofweek"), S)[0]) == nodes(a)
    path = shared_path(spark, "t-booster")
    a.save(spark, path)
    b = boosting.Booster.load(spark, path)
    assert nodes(b) == nodes(a) and b.base == a.base and [c.tolist() for c in b.cuts] == [c.tolist() for c in a.cuts]
    assert sum(f >= 0 for t in a.trees for f in t.feature) > 300
    columns = {f for t in a.trees[:1] for f in t.feature if f >= 0}
    assert len(columns) <= 6                            # of eight: the column sample of a tree


def test_rolling_origin_equals_brute_force(spark, feats):
    cuts, horizon = [START + dt.timedelta(days=d) for d in (28, 34)], 4
    got = {(r.cut, r.horizon): r for r in forecast.rolling_errors(feats, cuts, horizon, rounds=10, bins=16).collect()}
    counts = {(r[0], r[1]): r[2] for r in series(np.random.default_rng(1))}
    codes = {e: i for i, e in enumerate(sorted({e for e, _ in counts}))}
    small = boosting.Settings(rounds=10, bins=16)
    assert len(got) == 8
    for cut in cuts:
        model = plain(feats, small, cut)
        if cut == cuts[1]:          # bins are those of the first cut's rows
            model = None
        off, base = {h: [] for h in range(1, horizon + 1)}, {h: [] for h in range(1, horizon + 1)}
        for e, code in codes.items():
            lags = [counts[e, cut - dt.timedelta(days=k)] for k in range(5)]
            for h in range(1, horizon + 1):
                day = cut + dt.timedelta(days=h)
                base[h].append(counts[e, cut] - counts[e, day])
                if model:
                    x = np.array([[*lags, code, day.weekday(), day.day]], dtype=float)
                    lags = [max(0, round(model.predict(x)[0])), *lags[:4]]
                    off[h].append(lags[0] - counts[e, day])
        for h in base:
            r = got[cut, h]
            assert r.n == len(codes) and r.mae_last == pytest.approx(np.abs(base[h]).mean())
            assert r.rmse_last == pytest.approx(np.sqrt(np.mean(np.square(base[h]))))
            if model:
                assert r.mae_model == pytest.approx(np.abs(off[h]).mean())
                assert r.rmse_model == pytest.approx(np.sqrt(np.mean(np.square(off[h]))))


def test_unseen_days_of_a_weekly_cycle_are_forecast_better_than_by_the_last_count(spark):
    rows = [(f"e{i}", START + dt.timedelta(days=d), (i % 3 + 1) * (10 if (d % 7) in (0, 3) else 1))
            for i in range(12) for d in range(70)]
    f = forecast.stored_features(spark.createDataFrame(rows, "entity_text string, published_date date, count_mentions long"))
    got = forecast.rolling_errors(f, [START + dt.timedelta(days=62)], 7, rounds=60).collect()
    assert len(got) == 7
    assert np.mean([r.mae_model for r in got]) < 0.5 * np.mean([r.mae_last for r in got])


def test_no_rows_and_constant_counts(spark):
    schema = "entity_text string, published_date date, count_mentions long"
    assert forecast.forecast(spark.createDataFrame([], schema), maxIter=3).count() == 0
    flat = [("a", START + dt.timedelta(days=d), 4) for d in range(9)]
    assert [r.predicted_count for r in forecast.forecast(spark.createDataFrame(flat, schema), maxIter=3).collect()] == [4]


def test_cuts_of_a_wide_feature_follow_exact_counts():
    values = np.arange(1000)
    cuts = boosting.quantile_cuts(values, np.ones(1000, dtype=np.int64), 10)
    assert cuts.tolist() == [100.0 * i for i in range(1, 10)]
    assert boosting.quantile_cuts(np.array([5, 1]), np.array([9, 1]), 10).tolist() == [5.0]


def test_the_driver_reads_splits_and_no_histograms(spark, feats, monkeypatch):
    """What reaches the driver does not go by the number of tasks."""
    import pickle

    from pyspark import RDD

    read, collect = [], RDD.collect

    def counted(self):
        out = collect(self)
        read.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr(RDD, "collect", counted)
    small, sizes = boosting.Settings(rounds=2, bins=64), []
    until = [START + dt.timedelta(days=d) for d in (20, 30)]
    for n in (1, 6):
        read.clear()
        parted = feats.repartition(n, "group_id").cache()
        assert parted.rdd.getNumPartitions() == n
        models = boosting.fit(parted, small, until)
        sizes.append(sum(read))
        assert len(models) == 2 and len(read) >= 2 * small.depth
    # columns x models x nodes x six numbers, all levels of both rounds, and the frames around them
    assert max(sizes) <= 2 * (7 * 2 * 31 * 6 * 8 + 7 * small.depth * 200)
    assert abs(sizes[0] - sizes[1]) < sizes[0] / 2
