"""Incremental mention job on Structured Streaming.

``readStream`` over the message log -> ``foreachBatch`` that parses, extracts
and writes the mention fact and the batch's dates, both partitioned by query id
and batch id with dynamic overwrite (a query with a new checkpoint has a new
id, so its batch numbers never replace those of the old one). Progress is the query checkpoint (kept in the
shared checkpoint folder): a restarted query resumes after the last
committed batch, and a batch that is replayed after a crash overwrites its
own partitions instead of appending duplicates. With a manifest, the tables of
a batch become visible together, by its manifest row, which is written last; a
replayed batch that has one is left as it is. Each batch is persisted once
and read by both writes, so the source range is fixed per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.grid import entity_date_cells
from ..operators.mentions import mention_job
from ..schemas import ALLOWED_ENTITY_TYPES, NEWS_TOPIC, POSTS_TOPIC
from ..sinks.manifest import commit, is_committed
from ..sinks.tables import write_cells, write_dates, write_mentions


def query_id(spark, checkpoint: str) -> str:
    """Id of the query that a checkpoint belongs to; it is made with the
    checkpoint, before the first batch."""
    return spark.read.json(checkpoint.rstrip("/") + "/metadata").first().id


def mention_batch_writer(mentions_path: str, dates_path: str, checkpoint: str, extractor="pattern",
                         cells_path: str | None = None, allowed=ALLOWED_ENTITY_TYPES,
                         terms: DataFrame | None = None, manifest: str | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        run = query_id(batch.sparkSession, checkpoint)
        if manifest and is_committed(batch.sparkSession, manifest, run, batch_id):
            return
        batch = batch.persist()
        mentions = None
        try:
            news = batch.where(F.col("topic") == NEWS_TOPIC)
            posts = batch.where(F.col("topic") == POSTS_TOPIC)
            mentions, dates = mention_job(news, posts, extractor, terms=terms)
            if cells_path or manifest:
                mentions = mentions.persist()      # extracted once, read again
            write_mentions(mentions, mentions_path, batch_id, run)
            write_dates(dates, dates_path, batch_id, run)
            if cells_path:
                write_cells(entity_date_cells(mentions, allowed), cells_path, batch_id, run)
            if manifest:
                commit(mentions, manifest, run, batch_id)
        finally:
            if mentions is not None:
                mentions.unpersist()
            batch.unpersist()
    return write


def start_mention_stream(log_stream: DataFrame, mentions_path: str, dates_path: str,
                         checkpoint: str, extractor="pattern",
                         available_now: bool = True, interval: str | None = None,
                         cells_path: str | None = None,
                         allowed=ALLOWED_ENTITY_TYPES,
                         terms: DataFrame | None = None,
                         manifest: str | None = None) -> StreamingQuery:
    """Start the job; ``available_now`` processes everything unread in
    bounded batches and stops (one scheduled run), else it runs on
    ``interval``. With ``cells_path`` each batch also stores its
    pre-aggregated (entity, date) cells for an incremental daily grid;
    ``manifest`` names the table of commits."""
    writer = mention_batch_writer(mentions_path, dates_path, checkpoint, extractor, cells_path, allowed, terms,
                                  manifest)
    w = (log_stream.writeStream.foreachBatch(writer)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 day")
    return w.start()
