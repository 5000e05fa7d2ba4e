"""Query registry: each query is ``(spark, sf_dir) -> DataFrame`` over the
given tables, paired with the DuckDB SQL that must give the same rows. SQL is
``None`` where no SQL form exists (model training, parser form); the driver
then checks rows only. Shared SQL pieces of the fixture views live here too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import fixtures as fx


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str            # SURVEY ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ops: str):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def _allowed_sql(types) -> str:
    return ", ".join(f"'{t}'" for t in types)


# SQL forms of the fixture views (same projections as fixtures.py).
MENTIONS_CTE = (
    "mentions AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS entity_text, "
    "upper(event_type) AS entity_type, CAST(ts AS DATE) AS published_date FROM events)"
)
DATES_CTE = "dates AS (SELECT DISTINCT CAST(ts AS DATE) AS the_date FROM events)"
ALLOWED = _allowed_sql(fx.EVENT_ALLOWED_TYPES)
