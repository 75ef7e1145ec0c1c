"""Ordering helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by(name: str) -> Column:
    """Ascending, NULLs first: the order every tie-break uses."""
    return F.col(name).asc_nulls_first()


def rest_of(df: DataFrame, *named: str) -> list[str]:
    """The columns of ``df`` that are not among ``named``."""
    return [c for c in df.columns if c not in named]


def sorted_by(df: DataFrame, *leading: Column, named: tuple[str, ...] = ()) -> DataFrame:
    """Sort by ``leading``, then by every other column, then by input position.

    The extra columns settle ties. They also give the range exchange something
    to cut on when one leading value, or one group of identical rows, holds a
    large part of the table. A task that runs again must find its rows in the
    same positions, so ``df`` is to be a scan, or filters and projections of one.
    """
    others = [by(c) for c in rest_of(df, *named)]
    return df.orderBy(*leading, *others, F.monotonically_increasing_id())


def ratio(part: Column, whole: Column, digits: int = 2, unit: str = "1.0") -> Column:
    """``part`` in units of ``whole``, rounded half up; NULL for an empty whole.

    The division is done in decimals, so that a tie such as 1.005 rounds up
    whatever its nearest double is.
    """
    return F.round(F.try_divide(part * F.lit(Decimal(unit)), whole), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``ratio`` in percent."""
    return ratio(part, whole, digits, "100.0")
