"""Commits of batches. A batch writes several tables; it becomes visible when,
after all of them, its one manifest row is written. Readers that name the
manifest see the tables as of whole batches: a crash between two writes shows
none of them, and a batch that is committed is not written again.

A row holds the batch and the dates it touched, as text (NULL: rows without a
date), so that totals of other dates need no recount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_or_empty

SCHEMA = "dates array<string>, committed_at timestamp, run string, batch_id long"
BATCH = ("run", "batch_id")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed batches: run, batch_id, dates, committed_at."""
    return read_or_empty(spark, path, SCHEMA)


def is_committed(spark: SparkSession, path: str, run: str, batch_id: int) -> bool:
    found = read_manifest(spark, path).where((F.col("run") == run) & (F.col("batch_id") == batch_id))
    return not found.isEmpty()


def commit(rows: DataFrame, path: str, run: str, batch_id: int, date_col: str = "published_date") -> None:
    """Make a batch visible; ``rows`` tell which dates it touched."""
    touched = rows.select(F.col(date_col).cast("string").alias("d")).distinct()
    row = touched.agg(F.collect_list(F.coalesce("d", F.lit(""))).alias("dates")).select(
        F.transform("dates", lambda d: F.when(d != "", d)).alias("dates"), F.current_timestamp().alias("committed_at"),
        F.lit(run).alias("run"), F.lit(int(batch_id)).alias("batch_id"))
    (row.write.partitionBy(*BATCH).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def visible(table: DataFrame, manifest: str | None) -> DataFrame:
    """Rows of committed batches (all rows, without a manifest)."""
    if manifest is None:
        return table
    done = read_manifest(table.sparkSession, manifest).select(*BATCH)
    keyed = table.withColumn("run", F.col("run").cast("string")).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return keyed.join(done, list(BATCH), "left_semi")
