"""File sources: landed API responses, per-account post files, archives,
hand-off CSVs and the source list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NEWS_RESPONSE_SCHEMA, NEWS_SCHEMA, POST_SCHEMA_QUOTED


def read_news_responses(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """API responses ``{"articles": [...]}`` -> one row per article; a
    response without the key contributes nothing."""
    resp = spark.read.option("multiLine", multiline).schema(NEWS_RESPONSE_SCHEMA).json(path)
    empty = F.array().cast(T.ArrayType(NEWS_SCHEMA))
    return resp.select(F.explode(F.coalesce("articles", empty)).alias("a")).select("a.*")


def read_post_files(spark: SparkSession, directory: str, exclude=(),
                    schema: T.StructType = POST_SCHEMA_QUOTED) -> DataFrame:
    """Every ``*.json`` file of a directory whose root is an array of posts,
    minus the excluded file names; empty or blank files give no rows. The
    file name is kept so a merged read can be traced back."""
    df = (spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
          .schema(schema).json(directory)
          .withColumn("file_name", F.col("_metadata.file_name")))
    if exclude:
        df = df.where(~F.col("file_name").isin(list(exclude)))
    return df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, in whatever file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """An archive table if it exists, else an empty frame of ``schema``."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


COUNTS_CSV_SCHEMA = T.StructType([
    T.StructField("entity_text", T.StringType()),
    T.StructField("published_date", T.DateType()),
    T.StructField("count_mentions", T.LongType()),
])


def read_counts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of dense counts with the date column typed (no inference)."""
    return (spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
            .schema(COUNTS_CSV_SCHEMA).csv(path))


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Source list: one account name per line, blanks skipped."""
    return (spark.read.text(path).select(F.trim("value").alias("username"))
            .where(F.col("username") != ""))


def only_listed(rows: DataFrame, sources: DataFrame, account_col: str) -> DataFrame:
    """Rows of the listed accounts only."""
    listed = sources.select(F.col("username").alias(account_col)).distinct()
    return rows.join(listed, account_col, "left_semi")
