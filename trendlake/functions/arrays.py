"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(values: Column) -> Column:
    """Sums of an array's beginnings, by doubling strides: log2(size) passes
    over the array, not one for each element."""
    strides = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(2)))).cast("int") - 1)
    return F.aggregate(strides, values, lambda acc, s: F.transform(acc, lambda x, i: x + F.coalesce(
        F.get(acc, i - F.call_function("shiftleft", F.lit(1), s)), F.lit(0))))
