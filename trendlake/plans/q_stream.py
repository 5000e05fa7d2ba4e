"""End-to-end queries through the log, the stream and file round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import grid
from ..operators.mentions import mention_job, news_mentions
from ..schemas import ALLOWED_ENTITY_TYPES, NEWS_TOPIC, POSTS_TOPIC
from ..session import shared_path
from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sinks.tables import read_dates, read_mentions, write_counts_csv, write_json
from ..sources.files import read_counts_csv, read_news_responses
from ..sources.log import read_log_files, stream_log_files
from ..streaming.mention_stream import start_mention_stream
from ..streaming.window_counts import read_window_counts, start_window_counts, windowed_counts
from . import fixtures as fx
from .registry import register
from .batch_job import run_batch
from .recount import read_totals, recount
from .q_grid import _grid_sql, dense_daily_counts, dense_sql
from .q_text import (FULLTEXT_SQL, LABEL_SQL, NEWS_SQL, POSTS_SQL, found_sql,
                     news_from_documents, posts_from_conversations)

STREAM_LO, STREAM_HI = "2024-01-01", "2024-01-31"
_LABELS = ", ".join(f"'{t}'" for t in ALLOWED_ENTITY_TYPES)

PIPELINE_MENTIONS_SQL = f"""{NEWS_SQL}, {FULLTEXT_SQL}, {POSTS_SQL},
a AS (SELECT publishedAt AS d, unnest({found_sql('full_text')}) AS e FROM ft),
b AS (SELECT tweet_date AS d, unnest({found_sql("coalesce(tweet_content, '')")}) AS e FROM posts),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
mentions AS (SELECT lower(e) AS entity_text, {LABEL_SQL} AS entity_type, TRY_CAST(d AS DATE) AS published_date FROM u)"""
PIPELINE_GRID_SQL = dense_sql(f"""{PIPELINE_MENTIONS_SQL},
dates AS (SELECT TRY_CAST(publishedAt AS DATE) AS the_date FROM news UNION SELECT TRY_CAST(tweet_date AS DATE) FROM posts)""",
                              _LABELS, STREAM_LO, STREAM_HI)


def article_log(spark, sf_dir):
    """Articles (documents) and posts (conversations) as messages, by the
    library's own publisher columns."""
    news = news_from_documents(fx.table(spark, sf_dir, "documents"))
    posts = posts_from_conversations(fx.table(spark, sf_dir, "conversations"))
    nl = news.select(F.lit(NEWS_TOPIC).alias("topic"), (F.col("doc_id") % 2).cast("int").alias("partition"),
                     F.col("doc_id").alias("offset"),
                     F.to_json(F.struct("title", "description", "url", "publishedAt", "content"))
                     .cast("binary").alias("value"))
    pl = posts.select(F.lit(POSTS_TOPIC).alias("topic"), (F.col("conv_id") % 2).cast("int").alias("partition"),
                      (F.shiftleft("conv_id", 24) + F.col("turn")).alias("offset"),
                      F.to_json(F.struct("tweet_content", "tweet_date")).cast("binary").alias("value"))
    return nl.unionByName(pl)


def write_article_log(spark, sf_dir) -> str:
    """The messages as a file stand-in of the log, written as they come."""
    path = shared_path(spark, "log")
    article_log(spark, sf_dir).write.parquet(path)
    return path


@register("entity_grid_batch", PIPELINE_GRID_SQL, "PRJ1-8 UDF1 SET1 SET2 AGG3 full batch job")
def entity_grid_batch(spark, sf_dir):
    log = read_log_files(spark, write_article_log(spark, sf_dir))
    mentions, dates = mention_job(log.where(F.col("topic") == NEWS_TOPIC),
                                  log.where(F.col("topic") == POSTS_TOPIC))
    return grid.dense_daily_counts(mentions, dates, STREAM_LO, STREAM_HI)


@register("batch_resume", f"""
WITH {PIPELINE_MENTIONS_SQL}
SELECT entity_text, entity_type, published_date, count(*) AS n FROM mentions GROUP BY ALL
""", "SRC1 SRC2 SRC8 SNK1 SNK2 SNK9 FLT5 JON5")
def batch_resume(spark, sf_dir):
    """Two runs over a log that grew in between: the fact equals one run over
    all of it (the offsets of the first half are not read again)."""
    log = read_log_files(spark, write_article_log(spark, sf_dir))
    middle = F.when(F.col("topic") == NEWS_TOPIC, log.where(F.col("topic") == NEWS_TOPIC).agg(F.max("offset")).scalar())         .otherwise(log.where(F.col("topic") == POSTS_TOPIC).agg(F.max("offset")).scalar()) / 2
    root = shared_path(spark, "resume")
    run_batch(spark, log.where(F.col("offset") <= middle), root)
    run_batch(spark, log, root)
    fact = read_mentions(spark, root + "/trending_entities")
    return fact.groupBy("entity_text", "entity_type", "published_date").agg(F.count(F.lit(1)).alias("n"))


def _finished(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# Bytes of the log that a micro-batch takes: each batch costs several writes, so
# it is large; a cluster names what its executors can persist.
BATCH_BYTES = 512 << 20


def _ingested(spark, sf_dir, max_bytes: int = BATCH_BYTES) -> str:
    """The log streamed into tables, in bounded batches."""
    out = shared_path(spark, "stream")
    _finished(start_mention_stream(
        stream_log_files(spark, write_article_log(spark, sf_dir), max_bytes_per_trigger=max_bytes),
        out + "/mentions", out + "/dates", out + "/_checkpoint", cells_path=out + "/cells", manifest=out + "/_commits"))
    return out


@register("stream_daily_counts", PIPELINE_GRID_SQL, "STR1 STR2 STR3 STR4 SNK2 Q9 Q16")
def stream_daily_counts(spark, sf_dir):
    out = _ingested(spark, sf_dir)
    # incremental form: the grid is built from totals of the batches' stored cells
    recount(spark, out + "/cells", out + "/totals", out + "/_commits", out + "/_recounts")
    return grid.dense_counts_from_cells(read_totals(spark, out + "/totals"),
                                        read_dates(spark, out + "/dates", manifest=out + "/_commits"), STREAM_LO, STREAM_HI)


@register("stream_mention_fact", f"""
WITH {PIPELINE_MENTIONS_SQL}
SELECT entity_text, entity_type, published_date, count(*) AS n FROM mentions GROUP BY ALL
""", "SNK1 STR3")
def stream_mention_fact(spark, sf_dir):
    """The fact that the stream stored, read back."""
    out = _ingested(spark, sf_dir)
    fact = read_mentions(spark, out + "/mentions", out + "/_commits")
    return fact.groupBy("entity_text", "entity_type", "published_date").agg(F.count(F.lit(1)).alias("n"))


@register("bucketed_counts", _grid_sql(), "SNK1 AGG1 JON1")
def bucketed_counts(spark, sf_dir):
    """The grid from a fact that was stored in two batches, bucketed by entity."""
    ev = fx.table(spark, sf_dir, "events")
    table, path = f"fact_{uuid.uuid4().hex}", shared_path(spark, "bucketed")
    mentions = fx.event_mentions(ev)
    late = F.col("published_date") >= F.lit("2024-01-15").cast("date")
    for batch, rows in enumerate((mentions.where(~late), mentions.where(late | F.col("published_date").isNull()))):
        write_bucketed(rows, table, path, batch, buckets=8)
    fact = read_bucketed(spark, table, path, buckets=8)
    return grid.dense_daily_counts(fact, fx.event_dates(ev), fx.GRID_LO, fx.GRID_HI, fx.EVENT_ALLOWED_TYPES)


@register("stream_window_counts", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS window_start,
       'user_' || CAST(user_id AS VARCHAR) AS entity_text, COUNT(*) AS mentions
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
""", "STR5")
def stream_window_counts(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    src = shared_path(spark, "events")
    # landed in day folders; one bounded run reads whatever is there
    ev.withColumn("day", F.col("ts").cast("date")).write.partitionBy("day").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    mentions = stream.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_text"), "ts")
    out = shared_path(spark, "windows")
    _finished(start_window_counts(windowed_counts(mentions), out + "/t", out + "/_checkpoint"))
    r = read_window_counts(spark, out + "/t")
    return r.select(F.col("window_start").cast("date").alias("window_start"), "entity_text", "mentions")


@register("csv_roundtrip_counts", _grid_sql(), "SNK5 SRC7")
def csv_roundtrip_counts(spark, sf_dir):
    path = shared_path(spark, "csv")
    write_counts_csv(dense_daily_counts(spark, sf_dir), path)
    return read_counts_csv(spark, path)


@register("json_roundtrip_mentions", f"""
WITH {NEWS_SQL}, {FULLTEXT_SQL},
ents AS (SELECT publishedAt, unnest({found_sql('full_text')}) AS e FROM ft)
SELECT lower(e) AS entity_text, {LABEL_SQL} AS entity_type, TRY_CAST(publishedAt AS DATE) AS published_date
FROM ents
""", "SRC3 SNK6")
def json_roundtrip_mentions(spark, sf_dir):
    news = news_from_documents(fx.table(spark, sf_dir, "documents"))
    # landed API responses, written where their articles are read; every tenth
    # is followed by a failed one that has no articles
    article = F.struct("title", "description", "url", "publishedAt", "content")
    good = news.select(F.lit("ok").alias("status"), F.array(article).alias("articles"))
    bad = news.where(F.col("doc_id") % 10 == 0).select(F.lit("error").alias("status"))
    path = shared_path(spark, "responses")
    write_json(good.unionByName(bad, allowMissingColumns=True), path)
    return news_mentions(read_news_responses(spark, path, multiline=False))
