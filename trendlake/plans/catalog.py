"""All registered queries (importing this module registers them).

Names and output columns are the contract with ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_features, q_feeds, q_grid, q_pages, q_progress, q_records, q_stream, q_text  # noqa: F401
from .registry import REGISTRY, Query  # noqa: F401



def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: q.run for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n: q.sql for n, q in REGISTRY.items() if q.sql is not None}
