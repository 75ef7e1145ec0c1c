"""Two streams joined on a key within a bound of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.streaming.clickstream import timed


def followed_by(
    first: DataFrame, second: DataFrame, key: str, first_time: str, second_time: str, within: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Each row of ``first`` with the rows of ``second`` of its key at its time or up to ``within`` later.

    A row of ``first`` without one comes out with NULLs once both watermarks have passed the bound.
    Both sides have a watermark, and the condition bounds their distance, so a row leaves the state
    when none can match it any more. Rows later than the watermark are dropped, and so are rows of ``first`` without a
    time; those of ``second`` without key or time match nothing. Column names other than the key must differ.
    """
    left = timed(first, first_time, delay)
    right = timed(second.filter(F.col(key).isNotNull()), second_time, delay).withColumnRenamed(key, "_key")
    later = F.col(second_time) <= F.col(first_time) + F.expr(f"INTERVAL {within}")
    near = (F.col(key) == F.col("_key")) & (F.col(second_time) >= F.col(first_time)) & later
    return left.join(right, near, "left_outer").drop("_key")
