"""Warehouse reads over JDBC (thin; no database is started in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               num_partitions: int | None = None, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None) -> DataFrame:
    """Run ``query`` in the warehouse; with a partition column the read is
    split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", str(lower)).option("upperBound", str(upper))
             .option("numPartitions", str(num_partitions or 8)))
    else:
        r = r.option("query", query)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    return r.load()
