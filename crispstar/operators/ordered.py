"""What depends on the order of all rows, without a window over a key or over the table.

Rows are numbered by ``surrogate_key`` and cut into blocks of equal size, whatever their keys.
A window sees one block; what passes from block to block is one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crispstar.operators.keys import surrogate_key
from crispstar.session import materialize

BLOCK_ROWS = 1 << 16


def in_blocks(df: DataFrame, order_by: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``_place`` (1..n in the order of ``order_by``, ties by the other columns) and ``_block``."""
    return surrogate_key(df, order_by, "_place").withColumn("_block", F.floor((F.col("_place") - 1) / block_rows))


def _within(first: int | None, last: int) -> Window:
    return Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding if first is None else first, last)


def _with_earlier(blocks: DataFrame, summary: Column, carried: Column, name: str) -> DataFrame:
    """Each row with what ``carried`` makes of the summaries of all earlier blocks.

    The window without partitions has one row per block; it is written, so that Catalyst knows its size.
    """
    per_block = blocks.groupBy("_block").agg(summary.alias("_summary"))
    earlier = per_block.select(F.col("_block").alias("_of"), carried.alias(name))
    return blocks.join(materialize(earlier, "blocks"), F.col("_block") == F.col("_of"), "left").drop("_of")


def last_known(blocks: DataFrame, value: Column, name: str, up_to: int = 0) -> DataFrame:
    """Add the last ``value`` that is not NULL among the rows up to this one (``up_to=-1``: before it)."""
    place = F.when(value.isNotNull(), F.col("_place"))
    latest = F.last("_summary", ignorenulls=True).over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    joined = _with_earlier(blocks, F.max_by(value, place), latest, "_earlier")
    here = F.last(value, ignorenulls=True).over(_within(None, up_to))
    return joined.withColumn(name, F.coalesce(here, F.col("_earlier"))).drop("_earlier")


def running_sum(blocks: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows up to this one."""
    so_far = F.sum("_summary").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    joined = _with_earlier(blocks, F.sum(value), so_far, "_earlier")
    here = F.sum(value).over(_within(None, 0))
    return joined.withColumn(name, F.coalesce(F.col("_earlier"), F.lit(0)) + here).drop("_earlier")
