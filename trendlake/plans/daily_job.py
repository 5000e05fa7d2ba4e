"""The daily job end to end, as one call.

log (checkpointed stream, bounded run) -> mention fact + dates tables
-> dense entity x date counts -> lag features -> boosted-tree forecast
-> forecasts table. Every write is idempotent (batch id / forecast date), so
re-running a day after a failure replaces that day's output. All paths live
under ``root`` (shared storage on a cluster).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.forecast import forecast
from ..operators.grid import dense_counts_from_cells
from ..schemas import ALLOWED_ENTITY_TYPES, DEFAULT_GRID_RANGE
from ..sinks.tables import read_dates, write_counts_csv, write_trends
from ..streaming.mention_stream import start_mention_stream
from .recount import read_totals, recount


@dataclass
class DailyJob:
    root: str                                   # tables and checkpoints
    grid_range: tuple = DEFAULT_GRID_RANGE
    allowed: tuple = ALLOWED_ENTITY_TYPES
    extractor: str = "pattern"                  # 'pattern', 'gazetteer' or a maker of a model
    terms_path: str | None = None               # (term, label) table for 'gazetteer'
    dates_mode: str = "cumulative"              # or 'replace'
    count_only_allowed: bool = False
    export_csv: bool = False
    model_params: dict = field(default_factory=dict)

    @property
    def paths(self) -> dict:
        r = self.root.rstrip("/")
        return {"mentions": f"{r}/trending_entities", "dates": f"{r}/dates",
                "cells": f"{r}/entity_date_cells",
                "counts": f"{r}/entity_daily_counts", "trends": f"{r}/trends",
                "manifest": f"{r}/_commits", "totals": f"{r}/entity_date_totals", "recounts": f"{r}/_recounts",
                "checkpoint": f"{r}/_checkpoints/mentions", "csv": f"{r}/exports/entity_daily_counts"}

    def ingest(self, log_stream: DataFrame) -> None:
        """Read everything unread from the log and append it to the facts."""
        p = self.paths
        spark = log_stream.sparkSession
        terms = spark.read.parquet(self.terms_path) if self.terms_path else None
        q = start_mention_stream(log_stream, p["mentions"], p["dates"], p["checkpoint"],
                                 extractor=self.extractor, available_now=True,
                                 cells_path=p["cells"], allowed=self.allowed, terms=terms, manifest=p["manifest"])
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    def counts(self, spark: SparkSession) -> DataFrame:
        p = self.paths
        lo, hi = self.grid_range
        # only the dates that new batches touched are counted again
        recount(spark, p["cells"], p["totals"], p["manifest"], p["recounts"])
        return dense_counts_from_cells(read_totals(spark, p["totals"]),
                                       read_dates(spark, p["dates"], self.dates_mode, p["manifest"]),
                                       lo, hi, self.count_only_allowed)

    def run(self, spark: SparkSession, log_stream: DataFrame) -> DataFrame:
        """One scheduled run; returns the forecasts written."""
        p = self.paths
        self.ingest(log_stream)
        self.counts(spark).write.mode("overwrite").parquet(p["counts"])
        counts = spark.read.parquet(p["counts"])          # lineage cut at the hand-off
        if self.export_csv:
            write_counts_csv(counts, p["csv"], sort=True)
        trends = forecast(counts, **self.model_params)
        write_trends(trends, p["trends"])
        return spark.read.parquet(p["trends"])


def main(argv=None) -> None:
    """``spark-submit -m``-style entry: one scheduled run of the daily job."""
    import argparse

    from ..session import ensure_checkpoint_dir
    from ..sources.log import stream_log, stream_log_files

    ap = argparse.ArgumentParser(description="ingest the log, rebuild counts, forecast")
    ap.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    ap.add_argument("--log-path", help="file stand-in of the log (topic, partition, offset, value)")
    ap.add_argument("--kafka", help="bootstrap servers of the message log")
    ap.add_argument("--topics", default="news-topic,tweets-topic")
    ap.add_argument("--lo", default=DEFAULT_GRID_RANGE[0])
    ap.add_argument("--hi", default=DEFAULT_GRID_RANGE[1])
    ap.add_argument("--extractor", default="pattern")
    ap.add_argument("--terms-path")
    ap.add_argument("--dates-mode", default="cumulative", choices=["cumulative", "replace"])
    ap.add_argument("--export-csv", action="store_true")
    ap.add_argument("--max-iter", type=int, help="boosting rounds (default: the reference's 200)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("trendlake-daily").getOrCreate()
    ensure_checkpoint_dir(spark)
    log = (stream_log(spark, a.kafka, a.topics.split(",")) if a.kafka
           else stream_log_files(spark, a.log_path))
    job = DailyJob(root=a.root, grid_range=(a.lo, a.hi), extractor=a.extractor,
                   terms_path=a.terms_path, dates_mode=a.dates_mode, export_csv=a.export_csv,
                   model_params={"maxIter": a.max_iter} if a.max_iter else {})
    job.run(spark, log)


if __name__ == "__main__":
    main()
