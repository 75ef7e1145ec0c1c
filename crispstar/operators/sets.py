"""Differences of tables as multisets, and lists that hold NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.session import materialize


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that two tables of the same columns do not share, with ``change`` (added, removed) and ``copies``.

    Copies count, and NULL equals NULL, as with EXCEPT ALL both ways. Rows are counted with their sign in
    one shuffle, partly before it, so a row may be repeated any number of times.
    """
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    counted = signed.groupBy(*before.columns).agg(F.sum("_sign").alias("_left")).filter("_left <> 0")
    change = F.when(F.col("_left") > 0, "added").otherwise("removed")
    return counted.select(*before.columns, change.alias("change"), F.abs("_left").alias("copies"))


def table_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``multiset_difference`` where rows of a key that has some on both sides are ``changed from`` and ``changed to``. NULL is a key."""
    found = materialize(multiset_difference(before, after), "changes")
    sides = found.groupBy(F.col(key).alias("_key")).agg(F.count_distinct("change").alias("_sides"))
    both = sides.filter("_sides = 2").select("_key", F.lit(True).alias("_both"))
    side = F.when(F.col("change") == "added", "changed to").otherwise("changed from")
    marked = found.join(both, F.col(key).eqNullSafe(F.col("_key")), "left")
    return marked.withColumn("change", F.when(F.col("_both"), side).otherwise(F.col("change"))).drop("_key", "_both")


def not_exists(rows: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows for which the list has no equal value. A NULL on either side equals nothing, so rows with NULL stay."""
    values = listed.select(F.col(listed_column).alias("_listed"))
    return rows.join(values, F.col(column) == F.col("_listed"), "left_anti")


def not_in(rows: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose value is surely not in the list, as SQL's NOT IN: none if the list holds a NULL, all if it is empty.

    What the list holds is asked first, as two counts; then it is a plain anti join on the value, which any size
    of list can take, and not a join of every row with every entry.
    """
    entries, known = listed.agg(F.count("*"), F.count(listed_column)).first()
    if not entries:
        return rows
    if known < entries:
        return rows.filter(F.lit(False))
    return not_exists(rows.filter(F.col(column).isNotNull()), column, listed, listed_column)
