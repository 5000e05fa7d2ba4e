import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from trendlake.operators import latency as lat
from trendlake.session import shared_path


def test_days_merge_into_ranges_within_the_stated_error(spark):
    rng = np.random.default_rng(8)
    us = np.concatenate([rng.integers(0, 10_000, 30_000), rng.integers(10**6, 10**9, 30_000)])
    rng.shuffle(us)
    start = dt.datetime(2025, 8, 10)
    base = spark.createDataFrame([(int(v), i % 5) for i, v in enumerate(us)], "us long, d int")
    rows = base.select(
        F.timestamp_add("MICROSECOND", -F.col("us"), F.timestamp_add("DAY", F.col("d"), F.lit(start))).alias("ingested_at"),
        F.timestamp_add("DAY", F.col("d"), F.lit(start)).alias("stored_at"))
    odd = spark.createDataFrame([(None, start), (start, None)], rows.schema)
    path = shared_path(spark, "t-latency")
    lat.write_daily_latency(lat.daily_latency(rows.union(odd)), path)
    lat.write_daily_latency(lat.daily_latency(rows.where("day(stored_at) = 11")), path)     # made again: replaced
    days = lat.read_daily_latency(spark, path)
    assert [r.n for r in days.orderBy("day").collect()] == [12_000] * 5
    some = lat.read_daily_latency(spark, path, "2025-08-11", "2025-08-13")
    assert "PartitionFilters" in some._jdf.queryExecution().executedPlan().toString() and some.count() == 3
    for found, want in ((days, us), (some, us[np.isin(np.arange(len(us)) % 5, [1, 2, 3])])):
        shares = (0.01, 0.5, 0.95, 0.999)
        r = lat.merged_latency(found).select("n", "total_us", "min_us", "max_us",
                                             *[lat.latency_quantile(q) for q in shares]).first()
        assert tuple(r[:4]) == (len(want), want.sum(), want.min(), want.max())
        ranks = [(want <= v).mean() for v in r[4:]]
        assert all(abs(a - b) <= lat.RANK_ERROR for a, b in zip(ranks, shares))
    assert len(days.select("sketch").first()[0]) < 40_000


def test_no_rows(spark):
    rows = spark.createDataFrame([], "ingested_at timestamp, stored_at timestamp")
    assert lat.daily_latency(rows).count() == 0
