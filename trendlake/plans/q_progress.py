"""Progress, backlog and pipeline-report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import round_half_even_nonneg
from ..operators import latency as lat
from ..operators import progress, reports
from ..schemas import DEFAULT_SOURCES
from ..session import shared_path
from ..sinks.tables import write_trends
from ..sources.files import only_listed, read_sources
from . import fixtures as fx
from .registry import register

LOG_CTE = f"""
log AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'news-topic' ELSE 'tweets-topic' END AS topic,
  CAST(user_id % {fx.LOG_PARTITIONS} AS INTEGER) AS partition, event_id AS "offset", ts FROM events)"""
OLD_CTE = f"""old AS (SELECT topic, partition, max("offset") + 1 AS next_offset FROM log
  WHERE ts < TIMESTAMP '{fx.PROGRESS_CUTOFF}' GROUP BY topic, partition)"""
NEW_CTE = f"""new AS (SELECT topic, partition, max("offset") + 1 AS next_offset FROM log
  WHERE ts >= TIMESTAMP '{fx.PROGRESS_CUTOFF}' AND topic = 'news-topic' GROUP BY topic, partition)"""


def _log(spark, sf_dir):
    return fx.event_log(fx.table(spark, sf_dir, "events"))


def _old_new(spark, sf_dir):
    log = _log(spark, sf_dir)
    cut = F.lit(fx.PROGRESS_CUTOFF).cast("timestamp_ntz")
    old = progress.next_offsets(log.where(F.col("ts") < cut))
    # this run read only the news topic: the posts topic keeps its old offsets
    new = progress.next_offsets(log.where((F.col("ts") >= cut) & (F.col("topic") == "news-topic")))
    return log, old, new


@register("progress_offsets", f"""
WITH {LOG_CTE}
SELECT topic, partition, max("offset") + 1 AS next_offset FROM log GROUP BY topic, partition
""", "AGG9 Q7")
def progress_offsets(spark, sf_dir):
    return progress.next_offsets(_log(spark, sf_dir))


@register("progress_merge", f"""
WITH {LOG_CTE}, {OLD_CTE}, {NEW_CTE}
SELECT coalesce(new.topic, old.topic) AS topic, coalesce(new.partition, old.partition) AS partition,
       coalesce(new.next_offset, old.next_offset) AS next_offset
FROM old FULL OUTER JOIN new ON old.topic = new.topic AND old.partition = new.partition
""", "JON5 Q8")
def progress_merge(spark, sf_dir):
    _, old, new = _old_new(spark, sf_dir)
    return progress.merge_offsets(old, new)


@register("topic_lag", f"""
WITH {LOG_CTE}, {OLD_CTE},
ends AS (SELECT topic, partition, max("offset") + 1 AS next_offset FROM log GROUP BY topic, partition)
SELECT ends.topic AS topic, CAST(sum(greatest(ends.next_offset - coalesce(old.next_offset, 0), 0)) AS BIGINT) AS lag
FROM ends LEFT JOIN old ON ends.topic = old.topic AND ends.partition = old.partition
GROUP BY ends.topic
""", "AGG13")
def topic_lag(spark, sf_dir):
    log, old, _ = _old_new(spark, sf_dir)
    return progress.backlog_per_topic(progress.backlog(progress.next_offsets(log), old))


@register("rows_per_topic", f"""
WITH {LOG_CTE}
SELECT topic, COUNT(*) AS rows FROM log GROUP BY topic
""", "AGG10")
def rows_per_topic(spark, sf_dir):
    return reports.rows_per_topic(_log(spark, sf_dir))


_SOURCES_SQL = ", ".join(f"('{s}')" for s in DEFAULT_SOURCES)
SOURCE_STATUS_CTE = f"""
srcs AS (SELECT DISTINCT source FROM (SELECT source FROM documents UNION ALL SELECT * FROM (VALUES {_SOURCES_SQL}) v(source))),
cnt AS (SELECT source, COUNT(*) AS docs FROM documents WHERE length(trim(text)) > 0 GROUP BY source),
status AS (SELECT srcs.source AS source, coalesce(cnt.docs, 0) AS docs, coalesce(cnt.docs, 0) > 0 AS ok
           FROM srcs LEFT JOIN cnt ON srcs.source = cnt.source)"""


def _source_status(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    listed = spark.createDataFrame([(s,) for s in DEFAULT_SOURCES], "source string")
    srcs = docs.select("source").unionByName(listed).distinct()
    cnt = (docs.where(F.length(F.trim("text")) > 0).groupBy("source")
           .agg(F.count(F.lit(1)).alias("docs")))
    j = srcs.join(cnt, "source", "left")
    return j.select("source", F.coalesce("docs", F.lit(0)).alias("docs"),
                    (F.coalesce("docs", F.lit(0)) > 0).alias("ok"))


@register("source_status", f"WITH {SOURCE_STATUS_CTE}\nSELECT * FROM status",
          "SRC9 Q15 ingest status")
def source_status(spark, sf_dir):
    return _source_status(spark, sf_dir)


@register("ingest_summary", f"""
WITH {SOURCE_STATUS_CTE}
SELECT COUNT(*) AS total_sources, CAST(count_if(ok) AS BIGINT) AS successful,
       CAST(count_if(NOT ok) AS BIGINT) AS failed FROM status
""", "AGG11 Q15")
def ingest_summary(spark, sf_dir):
    return reports.ingest_summary(_source_status(spark, sf_dir))


@register("run_success", """
WITH runs AS (SELECT CAST(ts AS DATE) AS run_date, CAST(event_type <> 'error' AS INTEGER) AS ok,
  (epoch_us(ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT))) - epoch_us(ts)) / 1e6 AS duration_s
  FROM events)
SELECT run_date, COUNT(*) AS runs, round(avg(ok), 6) AS success_rate,
  round(avg(duration_s), 3) AS avg_duration_s, round(max(duration_s), 3) AS max_duration_s
FROM runs GROUP BY run_date
""", "AGG14 AGG15")
def run_success(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    micros = F.round(F.col("value") * 1_000_000).cast("long")
    runs = ev.select(
        F.col("ts").alias("started_at"),
        F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("ended_at"),
        (F.col("event_type") != "error").alias("ok"))
    # the approximate median is left out of the SQL-checked form
    return reports.run_report(runs, with_median=False)


# ---- latency from ingest to store --------------------------------------------------
QUANTILES = (0.5, 0.95, 0.99)
_US = """l AS (SELECT CAST(stored_at AS DATE) AS day, epoch_us(stored_at) - epoch_us(ts) AS us FROM (
  SELECT ts, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS stored_at FROM events))"""


def _stored_events(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    micros = F.round(F.col("value") * 1_000_000).cast("long")
    return ev.select(F.col("ts").alias("ingested_at"), F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("stored_at"))


def _off(exact: DataFrame, answers: DataFrame, by: list[str]) -> DataFrame:
    """How far the rank of each answer is from the wanted one, beyond what
    equal latencies explain: at most the sketch's error."""
    wanted = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), lat.latency_quantile(q).alias("us_q")) for q in QUANTILES]))
    rows = answers.select(*by, "n", wanted.alias("a")).select(*by, "n", "a.q", "a.us_q")
    return (rows.join(exact, by).groupBy(*by, "n", "q").agg(F.avg((F.col("us") < F.col("us_q")).cast("int")).alias("below"),
                                              F.avg((F.col("us") <= F.col("us_q")).cast("int")).alias("upto"))
            .select(*by, "n", "q", ((F.col("below") <= F.col("q") + lat.RANK_ERROR)
                                    & (F.col("upto") >= F.col("q") - lat.RANK_ERROR)).alias("within_bounds")))


@register("latency_by_day", f"""
WITH {_US}
SELECT day, count(*) AS n, round(avg(us), 3) AS avg_us, min(us) AS min_us, max(us) AS max_us FROM l GROUP BY day
""", "AGG14")
def latency_by_day(spark, sf_dir):
    """Stored daily rows, read back."""
    path = shared_path(spark, "latency")
    lat.write_daily_latency(lat.daily_latency(_stored_events(spark, sf_dir)), path)
    return lat.read_daily_latency(spark, path).select(
        "day", "n", F.round(F.col("total_us") / F.col("n"), 3).alias("avg_us"), "min_us", "max_us")


@register("latency_quantiles", f"""
WITH {_US}, q AS (SELECT unnest([{", ".join(map(str, QUANTILES))}])::DOUBLE AS q)
SELECT 'day ' || day AS span, n, q, TRUE AS within_bounds FROM (SELECT day, count(*) AS n FROM l GROUP BY day), q
UNION ALL SELECT 'all', n, q, TRUE FROM (SELECT count(*) AS n FROM l WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'), q
""", "AGG14 AGG15")
def latency_quantiles(spark, sf_dir):
    """Median, 95th and 99th of a hundred by day and over a range of days, from
    stored sketches, each held against the rank it has among all rows."""
    rows = _stored_events(spark, sf_dir)
    path = shared_path(spark, "latency")
    lat.write_daily_latency(lat.daily_latency(rows), path)
    exact = rows.select(F.col("stored_at").cast("date").alias("day"), lat.latency_us().alias("us"))
    lo, hi = "2024-01-05", "2024-01-20"
    days = _off(exact, lat.read_daily_latency(spark, path), ["day"])
    span = lat.merged_latency(lat.read_daily_latency(spark, path, lo, hi))
    inside = exact.where(F.col("day").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).select("us")
    whole = _off(inside.withColumn("one", F.lit(1)), span.withColumn("one", F.lit(1)), ["one"])
    return days.select(F.concat(F.lit("day "), F.col("day").cast("string")).alias("span"), "n", "q", "within_bounds").unionByName(
        whole.select(F.lit("all").alias("span"), "n", "q", "within_bounds"))


@register("newest_forecasts", f"""
WITH g AS (SELECT 'user_' || user_id AS group_id, CAST(ts AS DATE) AS date, count(*)::INT AS predicted_count
  FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT group_id, date, predicted_count, row_number() OVER (ORDER BY date DESC, predicted_count DESC, group_id) - 1 AS place
FROM g ORDER BY date DESC, predicted_count DESC, group_id LIMIT 25
""", "SRT3 SRT5 SNK8")
def newest_forecasts(spark, sf_dir):
    """The forecast preview over stored forecasts (each day's counts stand in),
    with the place that each row came out at."""
    ev = fx.table(spark, sf_dir, "events").where("ts IS NOT NULL")
    trends = ev.groupBy(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("group_id"),
                        F.col("ts").cast("date").alias("date")).agg(F.count(F.lit(1)).cast("int").alias("predicted_count"))
    path = shared_path(spark, "trends")
    write_trends(trends, path)
    stored = spark.read.parquet(path).select("group_id", F.col("date").cast("date").alias("date"), "predicted_count")
    shown = reports.recent_predictions(stored, 25)
    return shown.agg(F.collect_list(F.struct("group_id", "date", "predicted_count")).alias("rows")).select(
        F.posexplode("rows").alias("place", "r")).select("r.*", F.col("place").cast("bigint").alias("place"))


@register("rounded_halves", """
SELECT doc_id, greatest(0, round_even(n_chars / 2.0 - 300, 0))::INT AS rounded FROM documents
""", "FN13 PRJ15")
def rounded_halves(spark, sf_dir):
    """Every other value is a half; some are below zero."""
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", round_half_even_nonneg(F.col("n_chars") / 2 - 300).alias("rounded"))


@register("listed_sources", """
SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents GROUP BY source HAVING min(doc_id) % 2 = 0)
""", "SRC9")
def listed_sources(spark, sf_dir):
    """Rows of the accounts that a stored list names."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    path = shared_path(spark, "listed")
    named = docs.groupBy("source").agg(F.min("doc_id").alias("first")).where("first % 2 = 0")
    named.select(F.concat(F.lit(" "), "source").alias("value")).write.text(path)
    return only_listed(docs, read_sources(spark, path), "source")


@register("top_headlines", """
SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents
WHERE lang = 'en' ORDER BY doc_id LIMIT 10
""", "SRT4 SRT3")
def top_headlines(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return (d.where(F.col("lang") == "en").orderBy("doc_id").limit(10)
            .select("doc_id", F.split(F.col("text"), "\n").getItem(0).alias("title")))
