"""Row counts and missing values.

Every profile is one aggregate over one scan: map-side partial counts, one
small exchange, one row out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.functions.text import is_blank
from crispstar.operators.columns import percent


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def key_null_count(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNull()).agg(F.count("*").alias("null_keys"))


def _missing(name: str, mode: str) -> Column:
    c = F.col(name)
    if mode == "null":
        return c.isNull()
    if mode == "empty":
        # Comparing a number or a timestamp with '' raises in ANSI mode.
        return c.isNull() | (c.cast("string") == "")
    if mode == "blank":
        return is_blank(c)
    raise ValueError(f"unknown mode {mode!r}")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, mode: str = "null") -> DataFrame:
    """One row with the number of missing values of every column.

    ``mode`` says what is missing: ``null``, also ``''`` (``empty``), or also
    text of blanks (``blank``).
    """
    return df.agg(*[F.count_if(_missing(c, mode)).alias(f"{c}_nulls") for c in cols or df.columns])


def null_rate(df: DataFrame, col: str) -> DataFrame:
    nulls = F.count_if(F.col(col).isNull())
    return df.agg(
        F.count("*").alias("total_records"),
        nulls.alias("null_records"),
        percent(nulls, F.count("*")).alias("null_percentage"),
    )


def valid_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, and the set and missing values of the chosen columns."""
    total = F.count("*")
    out = [total.alias("total_rows")]
    for c in cols:
        out += [F.count(c).alias(f"{c}_set"), (total - F.count(c)).alias(f"{c}_missing")]
    return df.agg(*out)


def null_combination(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows that miss both columns, only the first, or only the second."""
    a, b = F.col(first).isNull(), F.col(second).isNull()
    return df.agg(
        F.count_if(a & b).alias("both_missing"),
        F.count_if(a & ~b).alias("first_missing"),
        F.count_if(~a & b).alias("second_missing"),
    )


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def null_share_by_group(df: DataFrame, col: str, group: str) -> DataFrame:
    """Of the rows that miss ``col``, the percentage in each group.

    The total is a scalar subquery over the counts: one number that is handed to
    every task and comes from the exchange the counts already have, so the
    groups need no join, no global window and no second scan.
    """
    counted = null_rows(df, col).groupBy(group).agg(F.count("*").alias("null_records"))
    total = counted.agg(F.sum("null_records")).scalar()
    return counted.withColumn("null_percentage", percent(F.col("null_records"), total))
