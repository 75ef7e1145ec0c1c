"""Sketches that are stored and merged, percentiles, all subtotals, and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers of a distinct count as a power of two: a relative standard error of about 0.8 %.
PRECISION = 14


def distinct_sketches(rows: DataFrame, by: list[str], counted: str, precision: int = PRECISION) -> DataFrame:
    """``by, sketch``: a HyperLogLog sketch of the distinct ``counted`` of each group, as binary; NULL is not counted.

    Written as a table, sketches of days are merged to any longer time without reading the rows again.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(counted, precision).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: list[str | Column], name: str) -> DataFrame:
    """The estimated distinct count of each group of sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def quantile_sketches(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, sketch``: a KLL sketch of the values of each group, as binary; NULL values are left out."""
    held = rows.filter(F.col(value).isNotNull())
    return held.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double")).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """``by`` and, under each name of ``shares``, a value of the group that about that share of its values does not exceed.

    With the default size the rank of the value is off by less than two in a hundred.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_merged"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("_merged", F.lit(p)).alias(n) for n, p in shares.items()])


def grouped_percentiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """The exact percentiles of each group, interpolated between values.

    The state of a group is its distinct values and their counts; for values without end use the sketches.
    """
    return rows.groupBy(*by).agg(*[F.percentile(F.col(value), F.lit(p)).alias(n) for n, p in shares.items()])


def subtotals(rows: DataFrame, by: list[str], *measures: Column) -> DataFrame:
    """The measures for every subset of ``by``, from one pass over the rows.

    ``grouped_by`` tells a subtotal from a group of NULLs: the columns that the row is grouped by, in order,
    joined by commas, empty for the total.
    """
    names = F.concat_ws(",", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in by])
    return rows.cube(*by).agg(names.alias("grouped_by"), *measures)


def pivoted(rows: DataFrame, by: list[str], column: str, values: list[str], measure: Column) -> DataFrame:
    """A row per group and a column per declared value; rows with another value, or none, count for no column.

    Values are declared, so that the table's columns do not depend on its rows and no pass seeks them.
    """
    return rows.groupBy(*by).pivot(column, values).agg(measure)
