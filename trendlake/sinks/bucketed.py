"""The mention fact bucketed and sorted by entity.

Every batch is dealt by entity once, when it is written; each bucket is a file
of its partition. Whatever groups or joins by entity afterwards (cells, the
grid, lag windows) finds the rows dealt already and needs no exchange of them.
The table lives in the session's catalog over files in a shared folder; a new
session opens it over the same files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists

BUCKETS = 64


def open_bucketed(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The fact table over ``path``, made known to this session if it is not
    yet. The number of buckets must be the one it was written with."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"""CREATE TABLE {table} (entity_text STRING, entity_type STRING, published_date DATE, run STRING, batch_id BIGINT)
            USING parquet PARTITIONED BY (run, batch_id)
            CLUSTERED BY (entity_text) SORTED BY (entity_text, published_date) INTO {int(buckets)} BUCKETS
            LOCATION '{path}'""")
        if exists(spark, path):
            spark.catalog.recoverPartitions(table)
    return spark.table(table)


def write_bucketed(mentions: DataFrame, table: str, path: str, batch_id: int, run: str = "batch",
                   buckets: int = BUCKETS) -> None:
    """Store a batch; a batch that is written again replaces itself."""
    spark = mentions.sparkSession
    open_bucketed(spark, table, path, buckets)
    dealt = mentions.select("entity_text", "entity_type", "published_date").repartition(buckets, "entity_text")
    view = f"batch_{uuid.uuid4().hex}"
    dealt.sortWithinPartitions("entity_text", "published_date").createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run = :run, batch_id = {int(batch_id)}) "
                  f"SELECT entity_text, entity_type, published_date FROM {view}".replace(":run", _quoted(run)))
    finally:
        spark.catalog.dropTempView(view)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_bucketed(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The fact's rows, dealt by entity."""
    return open_bucketed(spark, table, path, buckets).select(F.col("entity_text"), "entity_type", "published_date")
