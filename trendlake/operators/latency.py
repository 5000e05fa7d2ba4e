"""Latency from ingest to store, as mergeable quantile sketches.

Each day's latencies become one row: count, sum, extremes and a KLL sketch of
bounded size, made by partial aggregation (a day of most of the rows sends one
sketch a task). Days are stored as a table; a range of days is answered by
merging their sketches, without reading any row again. With ``k`` = 1000 the
rank of an answer is off by less than ``RANK_ERROR`` with high probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import write_partitioned

K = 1000
RANK_ERROR = 0.01


def latency_us(ingested: str = "ingested_at", stored: str = "stored_at") -> Column:
    """Microseconds from ingest to store."""
    return F.timestamp_diff("MICROSECOND", F.col(ingested), F.col(stored))


def daily_latency(rows: DataFrame, k: int = K, ingested: str = "ingested_at", stored: str = "stored_at") -> DataFrame:
    """(day, n, total_us, min_us, max_us, sketch) by day of storing; rows that
    lack one of the times are left out."""
    known = rows.select(F.col(stored).cast("date").alias("day"), latency_us(ingested, stored).alias("us")).where("us IS NOT NULL")
    return known.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("us").alias("total_us"), F.min("us").alias("min_us"), F.max("us").alias("max_us"),
        F.kll_sketch_agg_bigint("us", F.lit(k)).alias("sketch"))


def write_daily_latency(daily: DataFrame, path: str) -> None:
    """One folder a day; a day that is made again is replaced."""
    write_partitioned(daily, path, ["day"])


def read_daily_latency(spark: SparkSession, path: str, lo=None, hi=None) -> DataFrame:
    """Stored days from ``lo`` to ``hi``; the range reads only its folders."""
    days = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    if lo is not None:
        days = days.where(F.col("day") >= F.lit(str(lo)).cast("date"))
    if hi is not None:
        days = days.where(F.col("day") <= F.lit(str(hi)).cast("date"))
    return days


def merged_latency(daily: DataFrame, *by: str) -> DataFrame:
    """Days merged, all or by the given columns: the same columns but day."""
    return daily.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total_us").alias("total_us"), F.min("min_us").alias("min_us"),
        F.max("max_us").alias("max_us"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def latency_quantile(share: float, sketch: str = "sketch") -> Column:
    """Latency that ``share`` of the rows do not exceed, in microseconds."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(share)))
