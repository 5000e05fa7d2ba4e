"""Run the grid and the feed rules on data where one entity / one source
holds a third of all rows, with Spark's event log on, and report the largest
number of shuffle records any single task read. Run as a script (needs its
own session, since the event log is set when the context starts)."""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

N = 300_000


def main():
    logdir = tempfile.mkdtemp(prefix="evlog-")
    spark = (SparkSession.builder.master("local[4]").appName("skew-probe")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    from trendlake.session import ensure_checkpoint_dir
    from trendlake.operators.grid import dense_daily_counts
    from trendlake.operators.feeds import apply_feed_rules
    ensure_checkpoint_dir(spark)
    ids = spark.range(N, numPartitions=16)
    hot = F.col("id") % 3 == 0
    mentions = ids.select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("e"), (F.col("id") % 5000).cast("string"))).alias("entity_text"),
        F.when(F.col("id") % 2 == 0, F.lit("ORG")).otherwise(F.lit("DATE")).alias("entity_type"),
        # the hot entity's rows all fall on one day: one (entity, date) pair
        # and one day each hold a third of all rows
        F.when(hot, F.lit("2025-08-15").cast("date"))
         .otherwise(F.date_add(F.lit("2025-08-01").cast("date"), (F.col("id") % 30).cast("int")))
         .alias("published_date"))
    dates = mentions.select(F.col("published_date").alias("the_date")).distinct()
    g = dense_daily_counts(mentions, dates, "2025-08-01", "2025-08-30")
    hot_total = g.where("entity_text = 'hot'").agg(F.sum("count_mentions")).first()[0]
    feed = ids.select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("source"),
        F.col("id").alias("pos"), F.col("id").cast("string").alias("post_id"),
        (F.col("id") % 7 == 0).alias("is_repost"), F.lit("x").alias("content"),
        F.lit("2025-09-01").alias("date_text"))
    emitted_hot = apply_feed_rules(feed, max_posts=5, max_reposts=2, stop_date="2025-08-18") \
        .where("source = 'hot'").count()
    from trendlake.operators.feeds import take_while
    from trendlake.operators.reports import mentions_per_day
    kept_hot = take_while(feed, F.col("pos") >= 150_000).where("source = 'hot'").count()
    day = mentions_per_day(mentions).where("published_date = DATE'2025-08-15'").first()
    spark.stop()
    max_read, total_read = 0, 0
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                sr = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = sr.get("Total Records Read", 0)
                max_read = max(max_read, recs)
                total_read += recs
    print(json.dumps({"rows": N, "hot_rows": N // 3 + 1, "hot_total": hot_total,
                      "emitted_hot": emitted_hot, "kept_hot": kept_hot,
                      "hot_day_mentions": day["mentions"], "hot_day_entities": day["entities"],
                      "max_task_shuffle_records": max_read,
                      "all_shuffle_records": total_read}))


if __name__ == "__main__":
    main()
