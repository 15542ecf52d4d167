"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(name: str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(`{name}` as timestamp_ntz))")


def cols(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]


def no_nan(c: Column) -> Column:
    """NaN as null: Spark orders NaN above all numbers, NumPy compares it as false."""
    return F.when(~F.isnan(c), c)
