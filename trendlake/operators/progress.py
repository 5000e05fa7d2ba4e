"""Consumption progress of the message log, as tables.

A progress table is ``(topic, partition, next_offset)``. Everything is an
aggregate over (topic, partition) - a handful of rows however large the log -
so nothing but that small table is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_offsets(log: DataFrame) -> DataFrame:
    """Next offset to read per (topic, partition): max(offset) + 1 (rows may
    arrive in any order, so the last row seen is not used)."""
    return log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"))


def merge_offsets(old: DataFrame, new: DataFrame) -> DataFrame:
    """New progress wins per (topic, partition); partitions without new rows
    keep their old offset (the reference replaced a whole topic's map)."""
    o = old.select("topic", "partition", F.col("next_offset").alias("_old"))
    n = new.select("topic", "partition", F.col("next_offset").alias("_new"))
    return o.join(n, ["topic", "partition"], "full").select(
        "topic", "partition", F.coalesce("_new", "_old").alias("next_offset"))


def starting_offsets(saved: DataFrame | None, partitions: DataFrame) -> DataFrame:
    """Where to start each known (topic, partition): saved offset, else 0
    (a missing or unreadable progress table starts every topic at 0)."""
    if saved is None:
        return partitions.select("topic", "partition", F.lit(0).cast("long").alias("next_offset"))
    s = saved.select("topic", "partition", F.col("next_offset").alias("_s"))
    return partitions.join(s, ["topic", "partition"], "left").select(
        "topic", "partition", F.coalesce("_s", F.lit(0).cast("long")).alias("next_offset"))


def offsets_json(progress: DataFrame) -> DataFrame:
    """One row per topic with the connector's JSON form {"topic": {"p": n}}
    (the per-topic map is bounded by the topic's partition count)."""
    per_topic = progress.groupBy("topic").agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("partition").cast("string"), F.col("next_offset")))).alias("m"))
    return per_topic.select("topic", F.to_json(F.create_map(F.col("topic"), F.col("m"))).alias("json"))


def backlog(log_end: DataFrame, committed: DataFrame) -> DataFrame:
    """Unread messages per (topic, partition): end - committed, never < 0."""
    e = log_end.select("topic", "partition", F.col("next_offset").alias("_end"))
    c = committed.select("topic", "partition", F.col("next_offset").alias("_next"))
    return e.join(c, ["topic", "partition"], "left").select(
        "topic", "partition",
        F.greatest(F.col("_end") - F.coalesce("_next", F.lit(0)), F.lit(0)).alias("lag"))


def backlog_per_topic(lags: DataFrame) -> DataFrame:
    return lags.groupBy("topic").agg(F.sum("lag").alias("lag"))


def has_rows(df: DataFrame) -> bool:
    """"Any new messages?" test; stops at the first row."""
    return not df.isEmpty()


def read_progress(spark, path: str) -> DataFrame | None:
    """Progress as of the newest run, with its ``run_id``; None if there is no
    table yet (the caller then starts every partition at 0). Any other error
    is raised: taking it for "no progress" would read the whole log again."""
    from pyspark.sql import types as T

    from ..schemas import OFFSETS_SCHEMA
    from ..sources.files import read_or_empty
    saved = read_or_empty(spark, path, T.StructType([*OFFSETS_SCHEMA.fields, T.StructField("run_id", T.LongType())]))
    newest = saved.agg(F.max("run_id")).first()[0]
    return None if newest is None else saved.where(F.col("run_id") == newest)
