"""Publishing records to the message log (thin connector wrappers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_messages(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Each record -> JSON value; a ``topic`` column routes records when no
    fixed topic is given (one write for both feeds)."""
    cols = [c for c in df.columns if c != "topic"]
    out = df.select(F.to_json(F.struct(*cols)).alias("value"),
                    *(["topic"] if "topic" in df.columns and topic is None else []))
    return out if topic is None else out.withColumn("topic", F.lit(topic))


def publish(df: DataFrame, servers: str, topic: str | None = None) -> None:
    w = as_messages(df, topic).write.format("kafka").option("kafka.bootstrap.servers", servers)
    w.save()


def publish_files(df: DataFrame, path: str, topic: str, partitions: int = 2,
                  base_offset: int = 0) -> None:
    """File stand-in for the broker: (topic, partition, offset, value) rows.
    Offsets are unique and increasing per partition, with gaps."""
    msgs = as_messages(df, topic)
    msgs = msgs.withColumn("_id", F.monotonically_increasing_id())
    msgs.select(
        "topic",
        (F.abs(F.xxhash64("value")) % partitions).cast("int").alias("partition"),
        (F.col("_id") + F.lit(base_offset)).alias("offset"),
        F.col("value").cast("binary").alias("value"),
    ).write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **props) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in props.items():
        w = w.option(k, v)
    w.save()
