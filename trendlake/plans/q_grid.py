"""Grid, date-table and dashboard queries over the event mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid, reports
from ..operators.mentions import union_dates
from . import fixtures as fx
from .registry import ALLOWED, DATES_CTE, MENTIONS_CTE, register

_LO, _HI = fx.GRID_LO, fx.GRID_HI


def dense_sql(ctes: str, allowed: str, lo: str, hi: str, counted: str = "TRUE") -> str:
    """Dense grid in SQL: mentions are counted per cell first, the cells are
    then laid over all pairs of an allowed name and an observed day."""
    return f"""
WITH {ctes},
cell AS (SELECT entity_text, published_date, count(*) FILTER ({counted}) AS n FROM mentions GROUP BY ALL),
name AS (SELECT entity_text FROM mentions GROUP BY entity_text HAVING bool_or(entity_type IN ({allowed}))),
day AS (SELECT DISTINCT the_date AS published_date FROM dates WHERE the_date BETWEEN DATE '{lo}' AND DATE '{hi}')
SELECT entity_text, published_date, ifnull(n, 0) AS count_mentions
FROM (SELECT * FROM name, day) LEFT JOIN cell USING (entity_text, published_date)
"""


def _grid_sql(counted: str = "TRUE") -> str:
    return dense_sql(f"{MENTIONS_CTE}, {DATES_CTE}", ALLOWED, _LO, _HI, counted)


@register("dense_daily_counts", _grid_sql(), "JON1 JON2 AGG1 AGG2 FLT1 FLT2 Q1 Q4")
def dense_daily_counts(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return grid.dense_daily_counts(fx.event_mentions(ev), fx.event_dates(ev),
                                   _LO, _HI, fx.EVENT_ALLOWED_TYPES)


@register("dense_counts_allowed_only",
          _grid_sql(f"entity_type IN ({ALLOWED})"), "Q1 option")
def dense_counts_allowed_only(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return grid.dense_daily_counts(fx.event_mentions(ev), fx.event_dates(ev),
                                   _LO, _HI, fx.EVENT_ALLOWED_TYPES,
                                   count_only_allowed=True)


@register("allowed_entities", f"""
WITH {MENTIONS_CTE}
SELECT DISTINCT entity_text FROM mentions WHERE entity_type IN ({ALLOWED})
""", "FLT1 AGG2")
def allowed_entities(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return grid.allowed_entities(fx.event_mentions(ev), fx.EVENT_ALLOWED_TYPES)


@register("top_entities_week", f"""
WITH {MENTIONS_CTE}
SELECT entity_text, COUNT(*) AS mention_count
FROM mentions
WHERE published_date >= DATE '{fx.AS_OF}' - INTERVAL 7 DAY
GROUP BY entity_text
ORDER BY mention_count DESC, entity_text
LIMIT 10
""", "FLT7 AGG4 SRT2")
def top_entities_week(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return reports.top_entities(fx.event_mentions(ev), fx.AS_OF, days=7, k=10)


@register("mentions_per_day", f"""
WITH {MENTIONS_CTE}
SELECT published_date, COUNT(*) AS mentions, COUNT(DISTINCT entity_text) AS entities
FROM mentions GROUP BY published_date
""", "AGG12")
def mentions_per_day(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return reports.mentions_per_day(fx.event_mentions(ev))


@register("entity_mentions_per_day", f"""
WITH {MENTIONS_CTE}
SELECT published_date, entity_text, COUNT(*) AS mentions
FROM mentions GROUP BY published_date, entity_text
""", "AGG12")
def entity_mentions_per_day(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return reports.entity_mentions_per_day(fx.event_mentions(ev))


@register("total_mentions", f"""
WITH {MENTIONS_CTE}
SELECT COUNT(*) AS total_mentions FROM mentions
""", "AGG5")
def total_mentions(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return reports.total_mentions(fx.event_mentions(ev))


@register("mention_counts_by_entity", f"""
WITH {MENTIONS_CTE}
SELECT entity_text, COUNT(*) AS mention_count FROM mentions GROUP BY entity_text
""", "AGG4")
def mention_counts_by_entity(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return reports.mention_counts_by_entity(fx.event_mentions(ev))


@register("dates_distinct", """
SELECT DISTINCT the_date FROM (
  SELECT CAST(ts AS DATE) AS the_date FROM events
  UNION ALL
  SELECT CAST(o_orderdate AS DATE) AS the_date FROM orders)
""", "SET2 AGG3")
def dates_distinct(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    orders = fx.table(spark, sf_dir, "orders")
    return union_dates(ev.select(F.col("ts").cast("date").alias("the_date")),
                       orders.select(F.col("o_orderdate").cast("date").alias("the_date")))
