"""Daily totals by date, kept up by recounting touched dates only.

Totals hold one row per (date, entity), one folder per date. Batches committed
since the last recount name the dates they touched; the stored cells of these
dates, of all committed batches, are summed again and replace the totals of
these dates. Cells are thereby compacted: the grid reads totals, and cells of a
date are read again only when a later batch touches it. A recount that crashed
is repeated and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import merge_cells
from ..sinks.manifest import BATCH, SCHEMA, read_manifest
from ..sinks.tables import read_cells, write_partitioned


def new_batches(spark: SparkSession, manifest: str, recounts: str) -> DataFrame:
    """Committed batches that no recount has taken in."""
    done = read_manifest(spark, recounts).select(*BATCH)
    return (read_manifest(spark, manifest).join(done, list(BATCH), "left_anti")
            .select("dates", "committed_at", *BATCH))


def recount(spark: SparkSession, cells: str, totals: str, manifest: str, recounts: str) -> list[str | None]:
    """Bring the totals up to the manifest; returns the dates recounted (None
    stands for cells without a date)."""
    new = new_batches(spark, manifest, recounts).collect()      # one row a batch
    dates = sorted({d for r in new for d in r.dates}, key=str)
    if dates:
        # a batch committed meanwhile may be in the sums; the next recount takes its dates again
        seen = read_cells(spark, cells, manifest, dates)
        write_partitioned(merge_cells(seen).hint("rebalance", "published_date"), totals, ["published_date"])
    if new:
        write_partitioned(spark.createDataFrame(new, SCHEMA), recounts, list(BATCH))
    return dates


def read_totals(spark: SparkSession, totals: str) -> DataFrame:
    """Cells with one row per (entity, date)."""
    return spark.read.parquet(totals).select(
        "entity_text", F.col("published_date").cast("date").alias("published_date"), "n", "n_allowed")
