"""Views of the driver's tables that stand in for the pipeline's inputs.

The pipeline reads articles, posts, a message log and a mention fact; the test
tables are shaped differently, so each stand-in is a plain projection of a
given table (its work grows with the table). The same projections are written
in SQL in ``catalog.py`` for the DuckDB oracle.

Fixed parameters of the fixture queries live here, together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed fixture parameters ---------------------------------------------
EVENT_ALLOWED_TYPES = ("CLICK", "VIEW", "PURCHASE")   # stand-in for the 8 labels
GRID_LO, GRID_HI = "2024-01-03", "2024-01-28"         # export range (inclusive)
AS_OF = "2024-01-30"                                   # "today" of the reports
AS_OF_YEAR = 2024                                      # year for 'Mon d' dates
FEED_STOP_DATE = "2024-01-20"
FEED_MAX_POSTS = 12
FEED_MAX_REPOSTS = 4
LOG_PARTITIONS = 4
PROGRESS_CUTOFF = "2024-01-15"                         # end of the "previous" run


# Tables whose rows carry whole texts. A caller whose text files hold one row
# group each, fewer than its cores, names in this setting over how many
# partitions their rows are dealt; unset, files are read as they are.
TEXT_TABLES = ("documents", "pages", "conversations")
TEXT_PARTITIONS = "spark.trendlake.textPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(n)) if n and name in TEXT_TABLES else df


def event_mentions(events: DataFrame) -> DataFrame:
    """MENTIONS: each event is one mention of entity 'user_<id>' labelled
    with the upper-cased event type, dated by the event day."""
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_text"),
        F.upper("event_type").alias("entity_type"),
        F.col("ts").cast("date").alias("published_date"),
    )


def event_dates(events: DataFrame) -> DataFrame:
    """The cumulative ``dates`` table: distinct event days."""
    return events.select(F.col("ts").cast("date").alias("the_date")).distinct()


def event_log(events: DataFrame) -> DataFrame:
    """Events as a two-topic message log: clicks and views are the news topic,
    the rest the posts topic; partition = user_id mod 4; offset = event_id
    (offsets are increasing per partition, gaps allowed, as after compaction);
    the value is the event as JSON bytes."""
    topic = F.when(F.col("event_type").isin("click", "view"), F.lit("news-topic")) \
             .otherwise(F.lit("tweets-topic"))
    value = F.to_json(F.struct("event_id", "event_type", "props")).cast("binary")
    return events.select(
        topic.alias("topic"),
        (F.col("user_id") % LOG_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        value.alias("value"),
        F.col("ts").alias("ts"),
    )


def doc_published_at(doc_id_col: str) -> F.Column:
    """Articles carry no time in the test table: publishedAt is derived from
    the id as an ISO instant in January 2024."""
    day = (F.col(doc_id_col) % 30 + 1).cast("int")
    return F.format_string("2024-01-%02dT%02d:30:00Z", day, (F.col(doc_id_col) % 24).cast("int"))


# Post-date renderings of the feed fixture, chosen by event_id % 9: the
# eight strptime formats of the collector and the year-less 'Mon d' form.
FEED_DATE_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss'.000Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "M/d/yyyy", "MMM d",
)
FEED_DATE_PATTERNS_SQL = (
    "%Y-%m-%dT%H:%M:%S.000Z", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d", "%b %-d, %Y", "%B %-d, %Y", "%-d %b %Y", "%-m/%-d/%Y", "%b %-d",
)


def _feed_ts():
    # every 13th event carries a date 15 days older (a pinned/quoted post)
    return F.when(F.col("event_id") % 13 == 0, F.col("ts") - F.expr("INTERVAL 15 DAYS")) \
            .otherwise(F.col("ts"))


def feed_date_text(event_id: str = "event_id"):
    i = F.col(event_id) % len(FEED_DATE_PATTERNS)
    out = None
    for n, p in enumerate(FEED_DATE_PATTERNS):
        out = (F.when(i == n, F.date_format(_feed_ts(), p)) if out is None
               else out.when(i == n, F.date_format(_feed_ts(), p)))
    return out


def event_feed(events: DataFrame) -> DataFrame:
    """FEED: each user's events as a timeline, newest first (pos = -event_id).
    The post id is the payload's ``k`` (so copies repeat), none for errors;
    views are reposts; sign-ups have empty content; dates use FEED_DATE_PATTERNS."""
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("source"),
        (-F.col("event_id")).alias("pos"),
        "event_id",
        F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k")).alias("post_id"),
        (F.col("event_type") == "view").alias("is_repost"),
        F.when(F.col("event_type") == "signup", F.lit(""))
         .otherwise(F.concat(F.lit("post "), F.col("event_id").cast("string"))).alias("content"),
        feed_date_text().alias("date_text"),
    )
