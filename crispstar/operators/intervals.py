"""Completing intervals from one end and a duration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.functions.temporal import shift_hours


def impute_interval(df: DataFrame, start: str, end: str, hours: str) -> DataFrame:
    """Fill a missing end from the other end and the whole part of ``hours``.

    A negative duration moves the filled end to the wrong side, and rows that
    miss both ends stay as they are. Both columns must be timestamps already.
    """
    return df.withColumns(
        {
            start: F.coalesce(F.col(start), shift_hours(end, hours, -1)),
            end: F.coalesce(F.col(end), shift_hours(start, hours)),
        }
    )


def valid_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with at least one end whose ends are not inverted."""
    dated = F.col(start).isNotNull() | F.col(end).isNotNull()
    inverted = F.coalesce(F.col(start) > F.col(end), F.lit(False))
    return df.filter(dated & ~inverted)
