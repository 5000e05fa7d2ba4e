"""Feature, scoring and forecast queries on the event grid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import boosting
from ..operators import forecast as forecast_ops
from ..operators.forecast import forecast, score_next_day, stored_features
from ..operators.grid import allowed_entities
from ..schemas import N_LAGS
from ..session import shared_path
from ..sinks.tables import write_trends
from . import fixtures as fx
from .registry import register
from .q_grid import _grid_sql, dense_daily_counts

_LAGS = ", ".join(f"lag(count_mentions, {k}) OVER w AS lag_{k}" for k in range(1, N_LAGS + 1))
_NOTNULL = " AND ".join(f"lag_{k} IS NOT NULL" for k in range(1, N_LAGS + 1))

FEATURES_CTE = f"""
grid AS ({_grid_sql()}),
f AS (SELECT entity_text AS group_id, published_date, count_mentions AS target, {_LAGS}
      FROM grid WINDOW w AS (PARTITION BY entity_text ORDER BY published_date)),
d AS (SELECT * FROM f WHERE {_NOTNULL}),
feats AS (SELECT d.*, dense_rank() OVER (ORDER BY group_id) - 1 AS group_id_enc,
          CAST(isodow(published_date) - 1 AS INTEGER) AS dayofweek,
          CAST(dayofmonth(published_date) AS INTEGER) AS dayofmonth FROM d)"""


def _entities(spark, sf_dir):
    return allowed_entities(fx.event_mentions(fx.table(spark, sf_dir, "events")), fx.EVENT_ALLOWED_TYPES)


def _features(spark, sf_dir):
    return feat.lag_features(dense_daily_counts(spark, sf_dir), entities=_entities(spark, sf_dir))


@register("lag_features", f"WITH {FEATURES_CTE}\nSELECT * FROM feats",
          "WIN1 FLT3 AGG8 PRJ9 PRJ10 PRJ11 ML1 Q10 Q12")
def lag_features(spark, sf_dir):
    return _features(spark, sf_dir)


_SHIFT = ", ".join(["target AS lag_1"] + [f"lag_{k - 1} AS lag_{k}" for k in range(2, N_LAGS + 1)])


@register("scoring_rows", f"""
WITH {FEATURES_CTE},
nd AS (SELECT max(published_date) + INTERVAL 1 DAY AS nd FROM feats),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY published_date DESC) AS rn FROM feats) WHERE rn = 1)
SELECT group_id, CAST((SELECT nd FROM nd) AS DATE) AS date, {_SHIFT}, group_id_enc,
       CAST(isodow(CAST((SELECT nd FROM nd) AS DATE)) - 1 AS INTEGER) AS dayofweek,
       CAST(dayofmonth(CAST((SELECT nd FROM nd) AS DATE)) AS INTEGER) AS dayofmonth
FROM last
""", "WIN2 WIN3 PRJ14 AGG6 AGG7 JON3 JON4")
def scoring_rows(spark, sf_dir):
    return feat.scoring_rows(_features(spark, sf_dir))


# Rolling origin: cut dates and days ahead.
CUTS = (dt.date(2024, 1, 18), dt.date(2024, 1, 22))
HORIZON = 5


@register("forecast_next_day", None, "ML2 ML3 UDF3 PRJ11 PRJ15 FN13 AGG8")
def forecast_next_day(spark, sf_dir):
    """Boosted trees with the reference's settings (200 rounds, depth 5, row
    and column sample, L2): one forecast per entity."""
    return forecast(dense_daily_counts(spark, sf_dir), entities=_entities(spark, sf_dir))


@register("forecast_rows", None, "SNK8 ML4 SRT3")
def forecast_rows(spark, sf_dir):
    """The whole model, stored and read back: the stored forecasts, and what
    the stored model says of the same rows."""
    base = shared_path(spark, "trends")
    feats = stored_features(dense_daily_counts(spark, sf_dir), _entities(spark, sf_dir))
    model = boosting.fit(feats)[0]
    model.save(spark, base + "/model")
    write_trends(score_next_day(model, feats), base + "/trends")
    stored = spark.read.parquet(base + "/trends").select("group_id", F.col("date").cast("date").alias("date"), "predicted_count")
    again = score_next_day(boosting.Booster.load(spark, base + "/model"), feats)
    return stored.join(again.withColumnRenamed("predicted_count", "again"), ["group_id", "date"])


@register("rolling_errors", None, "ML2 ML3")
def rolling_errors(spark, sf_dir):
    """Errors of models trained up to each cut date on the days after it,
    beside those of repeating the last count."""
    feats = stored_features(dense_daily_counts(spark, sf_dir), _entities(spark, sf_dir))
    return forecast_ops.rolling_errors(feats, CUTS, HORIZON)


_CUTS = ", ".join(f"DATE '{d}'" for d in CUTS)


@register("rolling_baseline", f"""
WITH {FEATURES_CTE},
pairs AS (SELECT a.published_date AS cut, date_diff('day', a.published_date, b.published_date) AS horizon,
  CAST(a.target - b.target AS DOUBLE) AS off
  FROM feats a JOIN feats b ON a.group_id = b.group_id AND b.published_date > a.published_date
    AND date_diff('day', a.published_date, b.published_date) <= {HORIZON}
  WHERE a.published_date IN ({_CUTS}))
SELECT CAST(cut AS DATE) AS cut, CAST(horizon AS INTEGER) AS horizon, count(*) AS n, avg(abs(off)) AS mae_last,
  sqrt(avg(off * off)) AS rmse_last
FROM pairs GROUP BY ALL
""", "ML3")
def rolling_baseline(spark, sf_dir):
    """The same days, for repeating the last count."""
    return forecast_ops.baseline_errors(_features(spark, sf_dir), CUTS, HORIZON)
