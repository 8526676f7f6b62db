"""Casts that return NULL on bad input, and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_bigint(column: Column) -> Column:
    """Whole part of a numeric string; exact for nanosecond epochs.

    Only what is no plain whole number goes through a decimal.
    """
    return F.coalesce(column.try_cast("bigint"), column.try_cast("decimal(38,6)").try_cast("bigint"))


def nanos_to_timestamp(nanos: Column) -> Column:
    return F.timestamp_micros(F.call_function("div", nanos, F.lit(1000)))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, with an empty whole counted as one."""
    return part / F.when(whole > 0, whole).otherwise(1)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as double, NULL for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def zscore(value: Column, mean: Column, spread: Column) -> Column:
    """0 where the spread is zero or unknown; NULL where only the value is unknown."""
    return F.when(spread > 0, (value - mean) / spread).otherwise(F.lit(0.0))


def above(value: Column, limit: float | None) -> Column:
    """1 where value > limit; a limit of None never fires."""
    return F.lit(0) if limit is None else F.when(value > F.lit(limit), 1).otherwise(0)
