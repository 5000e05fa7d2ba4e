"""Dashboard and pipeline reports over the mention fact and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _date(d):
    return F.lit(str(d)).cast("date")


def top_entities(mentions: DataFrame, as_of, days: int = 7, k: int = 10) -> DataFrame:
    """Top-k entities by mentions since ``as_of - days`` (no upper bound, as
    in the dashboard query). Ties break on the entity text so the result is
    deterministic; Catalyst plans the order+limit as TakeOrderedAndProject,
    so no global sort runs."""
    since = F.date_sub(_date(as_of), days)
    return (mentions.where(F.col("published_date") >= since)
            .groupBy("entity_text").agg(F.count(F.lit(1)).alias("mention_count"))
            .orderBy(F.desc("mention_count"), F.asc("entity_text"))
            .limit(k))


def mention_counts_by_entity(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity_text").agg(F.count(F.lit(1)).alias("mention_count"))


def mentions_per_day(mentions: DataFrame) -> DataFrame:
    """Dashboard time series: mentions and distinct entities per day."""
    return mentions.groupBy("published_date").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.countDistinct("entity_text").alias("entities"))


def entity_mentions_per_day(mentions: DataFrame) -> DataFrame:
    """Per (day, entity) counts: one line per entity in the time-series panel."""
    return mentions.groupBy("published_date", "entity_text").agg(
        F.count(F.lit(1)).alias("mentions"))


def total_mentions(mentions: DataFrame) -> DataFrame:
    return mentions.agg(F.count(F.lit(1)).alias("total_mentions"))


def recent_predictions(trends: DataFrame, n: int = 10) -> DataFrame:
    """Newest forecasts first, biggest first within a date."""
    return (trends.orderBy(F.desc("date"), F.desc("predicted_count"), F.asc("group_id"))
            .limit(n))


def rows_per_topic(log: DataFrame) -> DataFrame:
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


def ingest_summary(per_source: DataFrame, ok_col: str = "ok") -> DataFrame:
    """One row: total / successful / failed sources."""
    ok = F.col(ok_col)
    return per_source.agg(
        F.count(F.lit(1)).alias("total_sources"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
    )


def run_report(runs: DataFrame, with_median: bool = True) -> DataFrame:
    """Per day: runs, success rate, mean / max / median duration (latency).

    ``runs`` has ``started_at``, ``ended_at`` (timestamps) and ``ok``. The
    median is ``percentile_approx`` - a bounded-size mergeable sketch - so a
    day holding most of the rows never gathers its values in one task.
    """
    # timestamp_diff on the columns as given: wall-clock (NTZ) inputs stay
    # independent of the session time zone
    dur = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1e6)
    return (runs.select(F.col("started_at").cast("date").alias("run_date"),
                        F.col("ok").cast("int").alias("ok"), dur.alias("duration_s"))
            .groupBy("run_date").agg(
                F.count(F.lit(1)).alias("runs"),
                F.round(F.avg("ok"), 6).alias("success_rate"),
                F.round(F.avg("duration_s"), 3).alias("avg_duration_s"),
                F.round(F.max("duration_s"), 3).alias("max_duration_s"),
                *([F.round(F.percentile_approx("duration_s", 0.5, 10000), 3)
                   .alias("median_duration_s")] if with_median else []),
            ))
