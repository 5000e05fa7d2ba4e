"""Payload parsing and text cleaning of articles and posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import join_non_null, space_trim

CORRUPT_COL = "_corrupt_record"


def parse_json_column(df: DataFrame, schema: T.StructType, value_col: str = "value",
                      keep=(), corrupt_col: str | None = CORRUPT_COL) -> DataFrame:
    """bytes/string JSON -> fixed struct -> flat columns.

    Keys outside ``schema`` are dropped; a value of another JSON type is read
    as its text (``{"title": 5}`` gives title '5'). Malformed input gives an
    all-NULL row; with ``corrupt_col`` the raw text is kept there so bad rows
    can be counted or side-written instead of vanishing silently.
    """
    fields = list(schema.fields)
    opts = {"mode": "PERMISSIVE"}
    if corrupt_col:
        fields.append(T.StructField(corrupt_col, T.StringType()))
        opts["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_json(F.col(value_col).cast("string"), T.StructType(fields), opts)
    return df.select(*keep, parsed.alias("_data")).select(*keep, "_data.*")


def clean_news(df: DataFrame) -> DataFrame:
    """Trim title/description/content (spaces only) and build ``full_text``
    as the space-joined non-NULL parts ('' when all are NULL)."""
    df = df.withColumns({c: space_trim(c) for c in ("title", "description", "content")})
    return df.withColumn("full_text", join_non_null("title", "description", "content"))


def bad_records(parsed: DataFrame, corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """Rows whose payload did not parse (side output)."""
    return parsed.where(F.col(corrupt_col).isNotNull())
