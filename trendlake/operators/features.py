"""Supervised lag features and the next-day scoring rows.

Input is the dense grid ``(entity_text, published_date, count_mentions)``.
The lag window, the "last row" test and the drop of incomplete rows all use
one window spec partitioned by entity, so the grid's own hash partitioning
(by entity) is reused and the whole feature build adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import weekday_monday0
from ..schemas import N_LAGS

LAG_COLS = [f"lag_{i}" for i in range(1, N_LAGS + 1)]
FEATURE_COLS = LAG_COLS + ["group_id_enc", "dayofweek", "dayofmonth"]


def _series_window():
    return Window.partitionBy("group_id").orderBy("published_date")


def ordinal_encode(df: DataFrame, key: str, out: str, n_ranges: int | None = None,
                   keys: DataFrame | None = None) -> DataFrame:
    """Code each distinct ``key`` with its 0-based rank in ascending order.

    Distributed: distinct keys are range-partitioned (sorted across
    partitions), numbered inside each partition, and shifted by the number of
    keys in the partitions before it (a table with one row per partition).
    The numbered keys are checkpointed to the shared checkpoint folder so a
    lost executor cannot renumber them; the result is joined back on ``key``.
    A caller that knows the distinct keys without computing ``df`` passes them
    as ``keys``.
    """
    spark = df.sparkSession
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = df.select(key).distinct() if keys is None else keys
    keys = (distinct.repartitionByRange(n, key)
            .sortWithinPartitions(key)
            .withColumn("_pid", F.spark_partition_id()))
    local = keys.withColumn(
        "_idx", F.row_number().over(Window.partitionBy("_pid").orderBy(key)) - 1)
    local = local.checkpoint(eager=True)
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    base = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_base"))
    # one row per range partition: broadcast is bounded by ``n``
    codes = local.join(F.broadcast(base), "_pid").select(
        key, (F.coalesce("_base", F.lit(0)) + F.col("_idx")).alias(out))
    return df.join(codes, key, "left")


def lag_features(grid: DataFrame, encode: bool = True, entities: DataFrame | None = None) -> DataFrame:
    """-> group_id, published_date, target, lag_1..lag_5[, group_id_enc],
    dayofweek (Mon=0), dayofmonth. Rows without all five lags are dropped
    (the first five dates of each entity); lags step over observed rows.
    ``entities`` are the distinct entities of the grid, if they are at hand:
    every entity of a grid has the same dates, so all of them or none get rows,
    and the encoder need not compute the grid to find them."""
    w = _series_window()
    df = grid.select(F.col("entity_text").alias("group_id"), "published_date",
                     F.col("count_mentions").alias("target"))
    df = df.select("*", *[F.lag("target", k).over(w).alias(f"lag_{k}")
                          for k in range(1, N_LAGS + 1)])
    df = df.na.drop(how="any", subset=["target", *LAG_COLS])
    df = df.withColumns({"dayofweek": weekday_monday0("published_date"),
                         "dayofmonth": F.dayofmonth("published_date")})
    if encode:
        keys = None if entities is None else entities.select(F.col("entity_text").alias("group_id"))
        df = ordinal_encode(df, "group_id", "group_id_enc", keys=keys)
    return df


def short_series(grid: DataFrame, n_lags: int = N_LAGS) -> DataFrame:
    """Entities whose series is too short to get a feature row (fewer than
    ``n_lags + 1`` dates): reported, not an error."""
    return (grid.groupBy("entity_text").agg(F.count(F.lit(1)).alias("dates"))
            .where(F.col("dates") <= n_lags))


def scoring_rows(features: DataFrame) -> DataFrame:
    """One next-day row per entity: the entity's last (target, lag_1..lag_4)
    become lag_1..lag_5, dated max(published_date) + 1 over all entities."""
    w = _series_window()
    next_date = F.date_add(features.agg(F.max("published_date")).scalar(), 1)
    last = features.withColumn("_next", F.lead("published_date").over(w)) \
                   .where(F.col("_next").isNull())
    shifted = {f"lag_{k}": F.col("target" if k == 1 else f"lag_{k - 1}")
               for k in range(1, N_LAGS + 1)}
    cols = [F.col("group_id"), next_date.alias("date")]
    cols += [shifted[c].alias(c) for c in LAG_COLS]
    if "group_id_enc" in features.columns:
        cols.append(F.col("group_id_enc"))
    cols += [weekday_monday0(next_date).alias("dayofweek"),
             F.dayofmonth(next_date).alias("dayofmonth")]
    return last.select(*cols)
