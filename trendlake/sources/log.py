"""Message-log sources.

The broker connector reads ``(topic, partition, offset, value)``; these thin
functions set it up. The connector jar is not in the test image, so tests
run the same column logic over a file stand-in with the identical shape
(``read_log_files`` / ``stream_log_files``) - the broker path itself is not
exercised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LOG_SCHEMA


def read_log(spark: SparkSession, servers: str, topic: str, starting_json: str,
             ending: str = "latest") -> DataFrame:
    """Bounded batch read of one topic from saved offsets to ``ending``."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_json)
            .option("endingOffsets", ending).load())


def stream_log(spark: SparkSession, servers: str, topics, min_partitions: int | None = None,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Checkpointed incremental read of the topics (progress lives in the
    query's checkpoint, not in a side file)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest"))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def stream_log_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.parquet(path)
