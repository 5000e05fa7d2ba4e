"""Next-day mention forecast: one global boosted-tree model over lag and
calendar features, retrained each run, scoring every entity at once; and its
check on days it has not seen. ``forecast`` uses the histogram booster;
``fit_model`` is the same model by MLlib's trees (no column sample per tree and
no L2 term)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import round_half_even_nonneg
from ..schemas import GBT_PARAMS, N_LAGS
from ..session import ensure_checkpoint_dir, shared_path, ship
from . import boosting
from .features import FEATURE_COLS, LAG_COLS, lag_features, scoring_rows

# Partitions that MLlib's trees are trained over: its row sampling goes by
# them, so they are fixed and not the cluster's.
TRAIN_PARTITIONS = 16


def fit_model(features: DataFrame, save_to: str | None = None, partitions: int | None = None,
              **overrides):
    """Fit VectorAssembler + GBTRegressor on all feature rows (no hold-out,
    as in the reference). Long boosting runs cut lineage every 10 rounds
    into the shared checkpoint folder. ``save_to`` persists the fitted
    pipeline (the reference retrains daily and keeps nothing)."""
    ensure_checkpoint_dir(features.sparkSession)
    params = {**GBT_PARAMS, **overrides}
    gbt = GBTRegressor(featuresCol="features", labelCol="target",
                       checkpointInterval=10, **params)
    asm = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features")
    # Entities are dealt by hash over a fixed number of partitions (or the
    # caller's), and ordered within each: row sampling goes by partition and
    # order, so the same input gives the same model on any cluster.
    n = partitions or TRAIN_PARTITIONS
    train = (features.repartition(n, "group_id").sortWithinPartitions("group_id", "published_date")
             .select(*FEATURE_COLS, F.col("target").cast("double").alias("target")))
    model = Pipeline(stages=[asm, gbt]).fit(train)
    if save_to:
        model.write().overwrite().save(save_to)
    return model


def predict_next_day(model, features: DataFrame) -> DataFrame:
    """-> (group_id, date, predicted_count) with max(0, round-half-even)."""
    rows = scoring_rows(features)
    return model.transform(rows).select(
        "group_id", "date",
        round_half_even_nonneg("prediction").alias("predicted_count"))


def settings_of(**overrides) -> boosting.Settings:
    """Booster settings; ``overrides`` may use the names of the fixed settings
    (maxIter, maxDepth, stepSize, subsamplingRate, seed) or the booster's own."""
    names = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "subsamplingRate": "rows"}
    return replace(boosting.Settings(), **{names.get(k, k): v for k, v in overrides.items()})


def score_next_day(model: boosting.Booster, features: DataFrame) -> DataFrame:
    """-> (group_id, date, predicted_count) with max(0, round-half-even)."""
    return boosting.with_predictions(model, scoring_rows(features)).select(
        "group_id", "date", round_half_even_nonneg("prediction").alias("predicted_count"))


def stored_features(grid: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Feature rows as a table in the shared folder: training passes over them
    many times and a lost executor must not compute them again."""
    spark = grid.sparkSession
    path = shared_path(spark, "features")
    lag_features(grid, entities=entities).write.parquet(path)
    return spark.read.parquet(path)


def forecast(grid: DataFrame, save_to: str | None = None, entities: DataFrame | None = None, **overrides) -> DataFrame:
    """Dense grid -> next-day forecasts for every entity with a feature row, by
    the histogram booster. ``save_to`` stores the model (the reference retrains
    daily and keeps nothing); ``entities`` as in ``lag_features``."""
    feats = stored_features(grid, entities)
    model = boosting.fit(feats, settings_of(**overrides))[0]
    if save_to:
        model.save(grid.sparkSession, save_to)
    return score_next_day(model, feats).checkpoint(eager=True)


# ---- rolling origin -----------------------------------------------------------

def _paths(features: DataFrame, cuts: Sequence[dt.date], horizon: int, models: list[boosting.Booster] | None) -> DataFrame:
    """(cut, group_id, horizon, date, predicted): from each cut date on, every
    entity's next days, each day's forecast being the next one's last lag. All
    cuts are one pass. Without models the last count is repeated."""
    order = sorted(cuts)
    ship(features.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).cast(pa.float64()).to_numpy() for c in ["target", *LAG_COLS, "group_id_enc"]], axis=1)
            cut = batch.column("cut").cast(pa.int32()).to_numpy()
            lags, code, last = x[:, :N_LAGS].copy(), x[:, -1], x[:, 0]
            for h in range(1, horizon + 1):
                days = (cut + h).astype("datetime64[D]")
                row = np.column_stack([lags, code, (cut + h + 3) % 7, (days - days.astype("datetime64[M]")).astype(int) + 1])
                predicted = last.copy()
                for i, d in enumerate(order if models else []):
                    mine = cut == d.toordinal() - boosting.EPOCH
                    predicted[mine] = np.maximum(0, np.rint(models[i].predict(row[mine])))
                lags = np.column_stack([predicted, lags[:, :-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cut"), batch.column("group_id"), pa.array(np.full(len(cut), h, dtype=np.int32)),
                     pa.array((cut + h).astype(np.int32)).cast(pa.date32()), pa.array(predicted)],
                    names=["cut", "group_id", "horizon", "date", "predicted"])

    starts = features.where(F.col("published_date").isin(*order)).select(
        F.col("published_date").alias("cut"), "group_id", "target", *LAG_COLS, "group_id_enc")
    return starts.mapInArrow(run, "cut date, group_id string, horizon int, date date, predicted double")


def _errors(paths: DataFrame, features: DataFrame, name: str) -> DataFrame:
    actual = features.select("group_id", F.col("published_date").alias("date"), "target")
    off = F.col("predicted") - F.col("target")
    return (paths.join(actual, ["group_id", "date"]).groupBy("cut", "horizon")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(off)).alias(f"mae_{name}"),
                 F.sqrt(F.avg(off * off)).alias(f"rmse_{name}")))


def baseline_errors(features: DataFrame, cuts: Sequence[dt.date], horizon: int) -> DataFrame:
    """(cut, horizon, n, mae_last, rmse_last) of repeating the cut day's count."""
    return _errors(_paths(features, cuts, horizon, None), features, "last")


def rolling_errors(features: DataFrame, cuts: Sequence[dt.date], horizon: int, **overrides) -> DataFrame:
    """Rolling-origin check. For each cut date a model is trained on the rows
    up to it, all at once, and forecasts the days after it, which it has not
    seen: (cut, horizon, n, mae_model, rmse_model, mae_last, rmse_last), against
    repeating the cut day's count. Days without a count are left out."""
    models = boosting.fit(features, settings_of(**overrides), until=sorted(cuts))
    scored = _errors(_paths(features, cuts, horizon, models), features, "model")
    return scored.join(baseline_errors(features, cuts, horizon).drop("n"), ["cut", "horizon"])
