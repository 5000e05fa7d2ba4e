"""Table sinks: mention fact, dates, dense counts, archives, forecasts,
progress. Writes that a retry may repeat overwrite their own partition
(batch id or date), so a re-run never duplicates rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .manifest import visible


def _dyn(w):
    return w.option("partitionOverwriteMode", "dynamic")


def write_partitioned(df: DataFrame, path: str, partition_cols, fmt: str = "parquet",
                      mode: str = "idempotent") -> None:
    """'idempotent': replace only the partitions present in ``df``;
    'append': add rows (repeats duplicate)."""
    w = df.write.partitionBy(*partition_cols).format(fmt)
    if mode == "idempotent":
        _dyn(w.mode("overwrite")).save(path)
    else:
        w.mode(mode).save(path)


def write_mentions(mentions: DataFrame, path: str, batch_id: int, run: str = "batch") -> None:
    """Mention fact, partitioned by date, then by the run that wrote it and its
    batch: a date range reads only its own folders, a replayed batch replaces
    its own rows, and batch numbers of another run (a stream with a new
    checkpoint counts from 0 again) never meet them. Rows are dealt by date
    before, so a date's folder gets a few files and not one of each task;
    adaptive execution splits dates of many rows. Files are sorted by entity."""
    mentions = mentions.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)))
    write_partitioned(mentions.hint("rebalance", "published_date").sortWithinPartitions("published_date", "entity_text"),
                      path, ["published_date", "run", "batch_id"])


def read_mentions(spark, path: str, manifest: str | None = None) -> DataFrame:
    """The mention fact, without the columns of its folders; with a manifest,
    of committed batches only."""
    return visible(spark.read.parquet(path), manifest).select(
        "entity_text", "entity_type", F.col("published_date").cast("date").alias("published_date"))


def write_dates(dates: DataFrame, path: str, batch_id: int, run: str = "batch") -> None:
    out = (dates.withColumn("stored_at", F.current_timestamp())
           .withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id))))
    write_partitioned(out, path, ["run", "batch_id"])


def write_cells(cells: DataFrame, path: str, batch_id: int, run: str = "batch") -> None:
    """Cells by date, then by run and batch, so that a recount of a few dates
    reads only their folders."""
    out = cells.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)))
    write_partitioned(out.hint("rebalance", "published_date"), path, ["published_date", "run", "batch_id"])


def read_cells(spark, path: str, manifest: str | None = None, dates: list[str | None] | None = None) -> DataFrame:
    """Stored cells (entity_text, published_date, n, n_allowed); ``dates``
    names the folders that are read (None in it: cells without a date)."""
    cells = spark.read.parquet(path)
    if dates is not None:
        day = F.col("published_date").cast("date")
        wanted = day.isin([F.lit(d).cast("date") for d in dates if d is not None])
        cells = cells.where(wanted | day.isNull() if None in dates else wanted)
    return visible(cells, manifest).select(
        "entity_text", F.col("published_date").cast("date").alias("published_date"), "n", "n_allowed")


def read_dates(spark, path: str, mode: str = "cumulative", manifest: str | None = None) -> DataFrame:
    """'cumulative': distinct dates of every batch; 'replace': only the last
    batch's dates (the behaviour of overwriting the table each run)."""
    d = visible(spark.read.parquet(path), manifest)
    if mode == "replace":
        d = d.where(F.col("stored_at") == d.agg(F.max("stored_at")).scalar())
    elif mode != "cumulative":
        raise ValueError(mode)
    return d.select("the_date").distinct()


def write_counts_csv(counts: DataFrame, path: str, sort: bool = False) -> None:
    """Dense counts as header CSV (hand-off for external tools). ``sort``
    orders the files by (entity, date) with a distributed range sort - only
    for consumers that need it; the pipeline itself never relies on order."""
    if sort:
        counts = counts.orderBy("entity_text", "published_date")
    counts.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_archive(df: DataFrame, path: str, ingest_date: str, fmt: str = "json") -> None:
    """Daily archive: one partition per ingest day, replaced if re-run."""
    write_partitioned(df.withColumn("ingest_date", F.lit(ingest_date).cast("date")),
                      path, ["ingest_date"], fmt)


def write_trends(trends: DataFrame, path: str) -> None:
    """Forecasts partitioned by forecast date: a re-run replaces that day."""
    write_partitioned(trends, path, ["date"])


def write_progress(progress: DataFrame, path: str, run_id: int) -> None:
    """Add the progress as of one run (after the data commit). Earlier runs
    stay, so a crash while this one is written loses nothing."""
    write_partitioned(progress.withColumn("run_id", F.lit(int(run_id))), path, ["run_id"])


def write_per_account(posts: DataFrame, path: str, account_col: str = "username") -> None:
    """One JSON directory per account."""
    posts.write.mode("overwrite").partitionBy(account_col).json(path)
