"""Feed-rule queries (date parsing, take-while, dedupe, caps, full rules)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_post_date, stop_flag
from ..operators import feeds
from . import fixtures as fx
from .registry import register

_N = len(fx.FEED_DATE_PATTERNS_SQL)
_TS = "CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL 15 DAY ELSE ts END"
_TEXT = "CASE " + " ".join(
    f"WHEN event_id % {_N} = {i} THEN strftime({_TS}, '{p}')"
    for i, p in enumerate(fx.FEED_DATE_PATTERNS_SQL)) + " END"
# Expected date, computed from the timestamp (not by parsing): the year-less
# rendering takes the as-of year.
_EXPECTED = (f"CASE WHEN event_id % {_N} = {_N - 1} THEN make_date({fx.AS_OF_YEAR}, "
             f"month({_TS}), day({_TS})) ELSE CAST({_TS} AS DATE) END")

FEED_CTE = f"""
feed AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS source, -event_id AS pos, event_id,
  CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS post_id,
  event_type = 'view' AS is_repost,
  CASE WHEN event_type = 'signup' THEN '' ELSE 'post ' || CAST(event_id AS VARCHAR) END AS content,
  {_TEXT} AS date_text, {_EXPECTED} AS parsed
  FROM events)"""


def _feed(spark, sf_dir):
    return fx.event_feed(fx.table(spark, sf_dir, "events"))


@register("parse_post_dates", f"""
WITH {FEED_CTE}
SELECT event_id, date_text, parsed AS post_date FROM feed
""", "FN6 UDF2")
def parse_post_dates(spark, sf_dir):
    f = _feed(spark, sf_dir)
    return f.select("event_id", "date_text",
                    parse_post_date("date_text", fx.AS_OF_YEAR).alias("post_date"))


@register("feed_take_while", f"""
WITH {FEED_CTE},
s AS (SELECT *, max(CASE WHEN parsed <= DATE '{fx.FEED_STOP_DATE}' THEN 1 ELSE 0 END)
      OVER (PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st
      FROM feed)
SELECT source, event_id FROM s WHERE st = 0
""", "WIN4 FLT8")
def feed_take_while(spark, sf_dir):
    f = _feed(spark, sf_dir)
    out = feeds.take_while(f, stop_flag(F.col("date_text"), fx.FEED_STOP_DATE, fx.AS_OF_YEAR))
    return out.select("source", "event_id")


@register("feed_dedupe", f"""
WITH {FEED_CTE}
SELECT source, post_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, post_id ORDER BY pos) AS r
  FROM feed WHERE post_id IS NOT NULL) WHERE r = 1
""", "WIN5 FLT9")
def feed_dedupe(spark, sf_dir):
    return feeds.dedupe_first(_feed(spark, sf_dir), ["source", "post_id"]) \
                .select("source", "post_id", "event_id")


@register("feed_cap", f"""
WITH {FEED_CTE}
SELECT source, is_repost, event_id, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY source, is_repost ORDER BY pos) AS rn FROM feed)
WHERE rn <= CASE WHEN is_repost THEN {fx.FEED_MAX_REPOSTS} ELSE {fx.FEED_MAX_POSTS} END
""", "WIN6")
def feed_cap(spark, sf_dir):
    f = _feed(spark, sf_dir)
    cap = F.when(F.col("is_repost"), F.lit(fx.FEED_MAX_REPOSTS)).otherwise(F.lit(fx.FEED_MAX_POSTS))
    return feeds.cap_within(f, ["source", "is_repost"], cap,
                           bound=max(fx.FEED_MAX_POSTS, fx.FEED_MAX_REPOSTS)).select("source", "is_repost", "event_id", "rn")


def _rules_sql(max_posts: int, max_reposts: int) -> str:
    repost = "is_repost" if max_reposts > 0 else "FALSE"
    return f"""
WITH {FEED_CTE},
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, post_id ORDER BY pos) AS r
      FROM feed WHERE post_id IS NOT NULL) WHERE r = 1),
k AS (SELECT *, CASE WHEN {repost} THEN 'repost' ELSE 'post' END AS kind FROM d),
e AS (SELECT * FROM k WHERE kind = 'repost' OR coalesce(content, '') <> ''),
n AS (SELECT *, row_number() OVER (PARTITION BY source, kind ORDER BY pos) AS rn FROM e),
cap AS (SELECT *, rn <= CASE WHEN kind = 'repost' THEN {max_reposts} ELSE {max_posts} END AS in_cap FROM n),
s AS (SELECT *, max(CASE WHEN kind = 'post' AND in_cap AND parsed <= DATE '{fx.FEED_STOP_DATE}' THEN 1 ELSE 0 END)
      OVER (PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM cap)
SELECT source, event_id, kind, CAST(rn AS INTEGER) AS rn FROM s WHERE st = 0 AND in_cap
"""


@register("feed_rules", _rules_sql(fx.FEED_MAX_POSTS, fx.FEED_MAX_REPOSTS), "WIN4 WIN5 WIN6 FLT8 FLT9 FLT11 Q21")
def feed_rules(spark, sf_dir):
    out = feeds.apply_feed_rules(_feed(spark, sf_dir), max_posts=fx.FEED_MAX_POSTS,
                                 max_reposts=fx.FEED_MAX_REPOSTS, stop_date=fx.FEED_STOP_DATE,
                                 as_of_year=fx.AS_OF_YEAR)
    return out.select("source", "event_id", "kind", "rn")


@register("feed_rules_live", _rules_sql(5, 0), "FLT11 Q24 live defaults")
def feed_rules_live(spark, sf_dir):
    """The live run's limits: 5 posts, reposts off (so they count as posts)."""
    out = feeds.apply_feed_rules(_feed(spark, sf_dir), max_posts=5, max_reposts=0,
                                 stop_date=fx.FEED_STOP_DATE, as_of_year=fx.AS_OF_YEAR)
    return out.select("source", "event_id", "kind", "rn")
