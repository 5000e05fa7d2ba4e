"""The mention job as a bounded batch over the log with saved progress.

1. load the progress of the newest run (none: every partition from 0);
2. keep log rows at or past each partition's next offset (a join with the
   progress table; the smallest offset of each topic also reaches the scan);
3. parse, extract and write facts and dates of this run;
4. merge the run's next offsets into the saved progress per partition and add
   them as this run's progress - only after the data commit.

A run's number follows from the saved progress, so a run that crashed before
step 4 is repeated under the same number and replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mentions import mention_job
from ..operators.progress import merge_offsets, next_offsets, read_progress
from ..schemas import NEWS_TOPIC, POSTS_TOPIC
from ..sinks.tables import write_dates, write_mentions, write_progress


def unread(log: DataFrame, progress: DataFrame | None) -> DataFrame:
    """Log rows not consumed yet."""
    if progress is None:
        return log
    p = progress.select("topic", "partition", F.col("next_offset").alias("_from"))
    # a few topics: their smallest offsets prune the scan, the join is exact
    lowest = p.groupBy("topic").agg(F.min("_from").alias("low")).collect()
    past = ~F.col("topic").isin([r.topic for r in lowest])
    for r in lowest:
        past = past | ((F.col("topic") == r.topic) & (F.col("offset") >= r.low))
    # a partition without progress is read from 0, whatever its topic's lowest is
    known = p.select("topic", "partition")
    fresh = log.join(known, ["topic", "partition"], "left_anti")
    seen = (log.where(past).join(p, ["topic", "partition"])
            .where(F.col("offset") >= F.col("_from")).drop("_from"))
    return seen.unionByName(fresh)


def run_batch(spark: SparkSession, log: DataFrame, root: str, run_id: int | None = None,
              extractor="pattern", terms: DataFrame | None = None) -> int:
    """One run; returns the number of log rows consumed."""
    r = root.rstrip("/")
    saved = read_progress(spark, f"{r}/progress")
    if run_id is None:
        run_id = 0 if saved is None else saved.first().run_id + 1
    batch = unread(log, saved).persist()
    try:
        n = batch.count()
        if n == 0:
            return 0
        mentions, dates = mention_job(batch.where(F.col("topic") == NEWS_TOPIC),
                                      batch.where(F.col("topic") == POSTS_TOPIC), extractor,
                                      terms=terms)
        write_mentions(mentions, f"{r}/trending_entities", run_id)
        write_dates(dates, f"{r}/dates", run_id)
        new = next_offsets(batch)
        merged = new if saved is None else merge_offsets(saved, new)
        write_progress(merged, f"{r}/progress", run_id)
        return n
    finally:
        batch.unpersist()
