"""Live variant of the trend count: per-entity daily mentions on a stream
with event-time windows and a watermark.

Rows later than the watermark are dropped (state for closed windows is
freed); each trigger's updated windows are written to a partition of its
batch id, and readers take the newest value per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import write_partitioned
from .mention_stream import query_id


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def windowed_counts(mentions: DataFrame, ts_col: str = "ts", watermark: str = "2 days",
                    window: str = "1 day") -> DataFrame:
    """Counts per (window, entity). A wall-clock (TIMESTAMP_NTZ) event time is
    mapped to the instant that reads the same in UTC (watermarks need an
    instant), windows are epoch-aligned, and the window start is mapped back
    to wall clock: day buckets do not depend on the session time zone."""
    ntz = isinstance(mentions.schema[ts_col].dataType, T.TimestampNTZType)
    m = mentions
    if ntz:
        m = m.withColumn(ts_col, F.timestamp_micros(
            F.timestamp_diff("MICROSECOND", _epoch(), F.col(ts_col))))
    start = F.col("w.start")
    if ntz:
        start = F.timestamp_add("MICROSECOND", F.unix_micros(start), _epoch())
    return (m.withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, window).alias("w"), "entity_text")
            .agg(F.count(F.lit(1)).alias("mentions"))
            .select(start.alias("window_start"), "entity_text", "mentions"))


def start_window_counts(counts: DataFrame, path: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        run = query_id(batch.sparkSession, checkpoint)
        out = batch.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)))
        write_partitioned(out, path, ["run", "batch_id"])

    w = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_window_counts(spark, path: str) -> DataFrame:
    """Final value per (window, entity): the one from the newest batch."""
    d = spark.read.parquet(path)
    return d.groupBy("window_start", "entity_text").agg(
        F.max_by("mentions", "batch_id").alias("mentions"))
