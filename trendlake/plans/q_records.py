"""Queries over records that are written to files and read back, over nested
scrape results, and over inputs with missing and damaged values."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import progress, scrape
from ..operators.clean import bad_records, parse_json_column
from ..operators.mentions import post_mentions
from ..schemas import LOG_SCHEMA, NEWS_TOPIC
from ..session import shared_path
from ..sinks.log import publish_files
from ..sinks.tables import append_archive, write_counts_csv, write_per_account, write_progress
from ..sources.files import read_counts_csv, read_or_empty, read_sources
from ..sources.log import read_log_files
from . import fixtures as fx
from .q_grid import _grid_sql, dense_daily_counts
from .q_progress import LOG_CTE
from .q_text import PROPS_SCHEMA, found_sql
from .registry import register


@register("published_log", """
SELECT doc_id, length(text) AS n FROM documents
""", "SNK3 SNK4 PRJ13 FN8")
def published_log(spark, sf_dir):
    """Records published as messages, read back from the log and parsed."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark, "published")
    publish_files(docs, path, NEWS_TOPIC)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    back = parse_json_column(read_log_files(spark, path), schema, corrupt_col=None)
    return back.select("doc_id", F.length("text").cast("bigint").alias("n"))


@register("archived_turns", """
SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS ingest_date
FROM conversations
""", "SRC5 SET4 SNK7")
def archived_turns(spark, sf_dir):
    """Two archived days, the first of them written twice."""
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    path = shared_path(spark, "archive")
    even = turns.where(F.col("turn") % 2 == 0)
    append_archive(even.limit(1), path, "2024-01-01")
    append_archive(even, path, "2024-01-01")
    append_archive(turns.where(F.col("turn") % 2 == 1), path, "2024-01-02")
    schema = T.StructType([*turns.schema.fields, T.StructField("ingest_date", T.DateType())])
    return read_or_empty(spark, path, schema, "json")


@register("per_account_files", """
SELECT source AS username, count(*) AS posts, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY source
""", "SNK10 SET3 FLT6")
def per_account_files(spark, sf_dir):
    """Posts in a folder per account, read back by folder."""
    docs = fx.table(spark, sf_dir, "documents").select(F.col("source").alias("username"), "doc_id", "n_chars")
    path = shared_path(spark, "accounts")
    write_per_account(docs, path)
    back = spark.read.schema("doc_id bigint, n_chars bigint, username string").json(path)
    return back.groupBy("username").agg(F.count(F.lit(1)).alias("posts"), F.sum("n_chars").alias("n_chars"))


@register("source_list", """
SELECT DISTINCT source AS username FROM documents
""", "SRC9")
def source_list(spark, sf_dir):
    """A list of accounts, one a line, with blank lines and space around."""
    names = fx.table(spark, sf_dir, "documents").select("source").distinct()
    path = shared_path(spark, "sources")
    lines = names.select(F.explode(F.array(F.concat(F.lit("  "), "source", F.lit(" ")), F.lit(""), F.lit("   "))).alias("value"))
    lines.write.text(path)
    return read_sources(spark, path)


@register("saved_starts", f"""
WITH {LOG_CTE}
SELECT topic, partition, CASE WHEN topic = 'news-topic' THEN max("offset") + 1 ELSE 0 END AS next_offset
FROM log GROUP BY topic, partition
""", "SRC8 SNK9 Q7")
def saved_starts(spark, sf_dir):
    """Where a run starts: from the newest saved progress (of one topic), else
    from 0."""
    log = fx.event_log(fx.table(spark, sf_dir, "events"))
    path = shared_path(spark, "progress")
    ends = progress.next_offsets(log)
    first = ends.where(F.col("topic") == NEWS_TOPIC)
    write_progress(first.withColumn("next_offset", F.lit(1).cast("bigint")), path, 0)
    write_progress(first, path, 1)
    return progress.starting_offsets(progress.read_progress(spark, path), ends)


@register("offsets_as_json", f"""
WITH {LOG_CTE}, n AS (SELECT topic, partition, max("offset") + 1 AS o FROM log GROUP BY topic, partition)
SELECT topic, partition, o AS next_offset FROM n
""", "PRJ12 PRJ16")
def offsets_as_json(spark, sf_dir):
    """The connector's JSON form of the offsets, taken apart again."""
    log = fx.event_log(fx.table(spark, sf_dir, "events"))
    js = progress.offsets_json(progress.next_offsets(log))
    maps = F.from_json("json", "map<string,map<string,bigint>>")
    parts = js.select("topic", F.explode(F.element_at(maps, F.col("topic"))).alias("p", "next_offset"))
    return parts.select("topic", F.col("p").cast("int").alias("partition"), "next_offset")


@register("unread_topics", f"""
WITH {LOG_CTE}
SELECT topic, count(*) > 0 AS has_rows FROM log GROUP BY topic
""", "FLT5 AGG10")
def unread_topics(spark, sf_dir):
    log = fx.event_log(fx.table(spark, sf_dir, "events"))
    rows = [(t, progress.has_rows(log.where(F.col("topic") == t))) for t in ("news-topic", "tweets-topic")]
    seen = spark.createDataFrame(rows, "topic string, has_rows boolean")
    return seen.join(log.select("topic").distinct(), "topic")


@register("damaged_payloads", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE TRY_CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  event_id % 5 = 0 AS bad FROM events WHERE length(props) > 2
""", "FN7 PRJ1 PRJ3 Q18")
def damaged_payloads(spark, sf_dir):
    """Every fifth payload is cut off; the side output holds exactly these."""
    ev = fx.table(spark, sf_dir, "events").where(F.length("props") > 2)
    cut = F.when(F.col("event_id") % 5 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    parsed = parse_json_column(ev.select("event_id", cut.alias("props")), PROPS_SCHEMA, "props", keep=("event_id",))
    bad = bad_records(parsed).select("event_id", F.lit(True).alias("bad"))
    return (parsed.join(bad, "event_id", "left")
            .select("event_id", "k", F.coalesce("bad", F.lit(False)).alias("bad")))


@register("missing_texts", f"""
SELECT lower(e) AS entity_text, count(*) AS n FROM (
  SELECT unnest({found_sql("text")}) AS e FROM conversations WHERE conv_id % 3 > 0 AND text IS NOT NULL) GROUP BY 1
""", "FLT4")
def missing_texts(spark, sf_dir):
    """Posts a third of which have no text."""
    posts = fx.table(spark, sf_dir, "conversations").select(
        F.when(F.col("conv_id") % 3 > 0, F.col("text")).alias("tweet_content"), F.lit("2024-01-01").alias("tweet_date"))
    return post_mentions(posts).groupBy("entity_text").agg(F.count(F.lit(1)).alias("n"))


@register("scraped_tables", """
WITH c AS (SELECT conv_id, 'u' || conv_id AS username, turn, role FROM conversations)
SELECT username, 'post' AS kind, count(*) AS n FROM c GROUP BY 1
UNION ALL SELECT username, 'repost', count(*) FROM c WHERE role = 'assistant' GROUP BY 1
UNION ALL SELECT username, 'edge', 2 * count(*) FROM c WHERE role = 'user' GROUP BY 1
UNION ALL SELECT username, 'profile', 1 FROM c WHERE conv_id % 2 = 0 GROUP BY 1
""", "PRJ17 PRJ18 FLT16 SRC4")
def scraped_tables(spark, sf_dir):
    """Nested scrape results (arrays that are empty are missing), written as
    JSON and flattened into their tables. Profiles of every other account have
    neither name nor bio and are not usable."""
    c = fx.table(spark, sf_dir, "conversations")
    user = F.concat(F.lit("u"), F.col("conv_id").cast("string"))

    def some(cond, struct):
        found = F.collect_list(F.when(cond, struct))
        return F.when(F.size(found) > 0, found)
    text = F.col("turn").cast("string")
    nested = c.groupBy(user.alias("username"), "conv_id").agg(
        some(F.lit(True), F.struct(text.alias("tweet_content"), F.lit("Unknown").alias("tweet_date"))).alias("tweets"),
        some(F.col("role") == "assistant", F.struct(text.alias("retweet_content"))).alias("retweets"),
        some(F.col("role") == "user", F.struct(text.alias("follower_name"))).alias("followers"),
        some(F.col("role") == "user", F.struct(text.alias("following_name"))).alias("following"))
    path = shared_path(spark, "scraped")
    nested.withColumn("user_profile", F.struct(F.lit("").alias("username"), F.lit(" A wire. Follow ").alias("bio"))).write.json(path)
    r = spark.read.schema(T.StructType([*scrape.SCRAPE_RESULT_SCHEMA.fields, T.StructField("conv_id", T.LongType())])).json(path)
    profiles = scrape.profiles_of(r).where("bio = 'A wire.' AND display_name = username")
    odd = F.col("username").substr(2, 20).cast("bigint") % 2 == 1
    blank = lambda x: F.when(~odd, F.col(x)).otherwise(F.lit(""))
    usable = scrape.usable_profiles(profiles.select("username", blank("display_name").alias("display_name"), blank("bio").alias("bio")))
    tables = {"post": scrape.posts_of(r), "repost": scrape.reposts_of(r), "edge": scrape.edges_of(r), "profile": usable}
    out = None
    for kind, table in tables.items():
        n = table.groupBy("username").agg(F.count(F.lit(1)).alias("n")).select("username", F.lit(kind).alias("kind"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@register("sorted_csv_counts", _grid_sql(), "SRT1 SNK5 SRC7")
def sorted_csv_counts(spark, sf_dir):
    path = shared_path(spark, "sorted_csv")
    write_counts_csv(dense_daily_counts(spark, sf_dir), path, sort=True)
    return read_counts_csv(spark, path)


@register("empty_log", """
SELECT topic, count(*) AS n FROM (SELECT '' AS topic FROM events WHERE FALSE) GROUP BY topic
""", "SRC5")
def empty_log(spark, sf_dir):
    """An archive that is not there reads as an empty table of its schema,
    here joined to the events' log."""
    log = fx.event_log(fx.table(spark, sf_dir, "events")).select("topic", "offset")
    none = read_or_empty(spark, shared_path(spark, "nothing"), LOG_SCHEMA)
    return log.join(none.select("topic", "offset"), ["topic", "offset"]).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
