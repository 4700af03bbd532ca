"""Working out a costly expression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that later filters and selections read instead of working them out again.

    Spark moves a filter below a selection by writing the selected expressions into it, so that a
    costly one is run for the filter and again for the result. It does not do so with the output
    of a generator, here one that makes a single row.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
