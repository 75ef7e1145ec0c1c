"""Duplicate and distinct keys.

Keys are always counted before anything is joined, with map-side partial
counts, so a key that holds a large part of the rows reaches the shuffle as one
record per task. NULL counts as one key wherever rows are grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crispstar.operators.columns import by, percent, rest_of, sorted_by
from crispstar.session import materialize


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("records"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once with their count, most frequent first."""
    dups = key_counts(df, key).filter("records > 1")
    return dups.orderBy(F.col("records").desc(), by(key))


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    return key_counts(df, key).agg(F.count_if(F.col("records") > 1).alias("duplicate_keys"))


def duplicate_key_pct(df: DataFrame, key: str) -> DataFrame:
    """Number of duplicated keys as a percentage of the number of rows."""
    dups, rows = F.count_if(F.col("records") > 1), F.sum("records")
    return key_counts(df, key).agg(
        dups.alias("duplicate_keys"),
        F.coalesce(rows, F.lit(0)).alias("total_rows"),
        percent(dups, rows).alias("duplicate_percentage"),
    )


def _duplicated(df: DataFrame, key: str) -> DataFrame:
    """The duplicated keys as a written table.

    Joined straight from the aggregate, the keys would already be partitioned
    for the join, and AQE splits a skewed partition only between two plain
    exchanges. As a table the keys are broadcast while they are small, and the
    sort-merge join beyond that can be split when one key is hot.
    """
    return materialize(key_counts(df, key).filter("records > 1").select(key), "duplicated-keys")


def duplicate_records(df: DataFrame, key: str, ordered: bool = True) -> DataFrame:
    """All rows of the duplicated keys, sorted by key; NULL keys match nothing.

    The rows found are written before they are sorted: the sort tells identical
    copies apart by their position, and a written table keeps positions.
    """
    found = df.join(_duplicated(df, key), key, "left_semi")
    return sorted_by(materialize(found, "duplicate-records"), by(key), named=(key,)) if ordered else found


def unique_records(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not duplicated. Rows without a key stay."""
    return df.join(_duplicated(df, key), key, "left_anti")


def duplicate_group_nulls(df: DataFrame, key: str, col: str) -> DataFrame:
    """Per duplicated key: its records and how many of them miss ``col``.

    The rows of one key never have to meet: both numbers come out of the same
    partial aggregate.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("records"), F.count_if(F.col(col).isNull()).alias("null_values")
    )
    return per_key.filter("records > 1")


def duplicate_null_histogram(df: DataFrame, key: str, col: str) -> DataFrame:
    """How many duplicated keys have 0, 1, 2 ... records without ``col``."""
    per_key = duplicate_group_nulls(df, key, col)
    return per_key.groupBy("null_values").agg(F.count("*").alias("keys")).orderBy("null_values")


def total_vs_distinct(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Rows beside distinct non-NULL keys; ``approximate`` trades exactness for one small sketch."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.agg(F.count("*").alias("total_rows"), distinct.alias("unique_keys"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values, NULL included."""
    return df.select(col).distinct().agg(F.count("*").alias("distinct_values"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(by(col))


def surrogate_key_check(df: DataFrame, key: str) -> DataFrame:
    """Smallest, largest and number of distinct keys beside the rows: a dense key has 1, n, n, n."""
    return df.agg(
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        F.count_distinct(F.col(key)).alias("distinct_keys"),
        F.count("*").alias("total_rows"),
    )


def dedup_by_key(
    df: DataFrame, key: str, order_by: list | None = None, keep_null_keys: bool = False
) -> DataFrame:
    """One row per key: the first by ``order_by``.

    The default order is every other column, NULLs first, so reruns agree. Rows
    without a key count as one key unless ``keep_null_keys`` is set. The filter
    on the row number lets Spark keep one row per key in each map task already,
    so a hot key does not travel.
    """
    given = order_by or []
    order = [by(c) if isinstance(c, str) else c for c in given] + [by(c) for c in rest_of(df, key)]
    keyed = df.filter(F.col(key).isNotNull()) if keep_null_keys else df
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    kept = keyed.withColumn("_place", place).filter("_place = 1").drop("_place")
    return kept.unionByName(df.filter(F.col(key).isNull())) if keep_null_keys else kept
