"""Joins on time: the latest earlier row, and points within intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.operators.ordered import BLOCK_ROWS, in_blocks, last_known
from crispstar.session import materialize

# Lengths of the buckets of each level, in seconds: an hour, and each next 16 times as long.
BUCKETS = tuple(3600 * 16**level for level in range(8))


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    take: dict[str, str],
    strict: bool = False,
    tolerance: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every left row with the latest right row of its key at its time or before (``strict``: before).

    ``take`` names the right columns to add and what to call them. Of right rows of one key and time
    the largest by the columns taken counts. Left rows without a key, a time or an earlier right row
    stay with NULLs; right rows without a key or time are not used. With a ``tolerance``, such as
    ``1 day``, an older right row is no match.

    Both sides are put into one order by key and time. The row sought is then the last right row
    before, if it has the same key: no window over a key, so a hot key is cut into blocks like any other.
    """
    added = F.struct(F.col(right_time).alias("_at"), *[F.col(c).alias(n) for n, c in take.items()])
    rows = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.lit(0 if not strict else 1).alias("_side"), added.alias("_right")
    )
    asked = left.select(
        F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1 if not strict else 0).alias("_side"), F.struct(*left.columns).alias("_left")
    )
    both = asked.unionByName(rows, allowMissingColumns=True)
    ordered = in_blocks(both, ["_key", "_time", "_side", "_right"], block_rows)
    known = F.when(F.col("_right").isNotNull(), F.struct("_key", "_right"))
    found = last_known(ordered, known, "_found").filter(F.col("_left").isNotNull())
    same = (F.col("_found._key") == F.col("_key")) & F.col("_time").isNotNull()
    if tolerance is not None:
        same &= F.col("_time") - F.col("_found._right._at") <= F.expr(f"INTERVAL {tolerance}")
    return found.select(
        *[F.col(f"_left.`{c}`").alias(c) for c in left.columns], *[F.when(same, F.col(f"_found._right.`{n}`")).alias(n) for n in take]
    )


def _seconds(time: Column) -> Column:
    """Whole seconds of a wall clock time."""
    return F.floor(F.unix_micros(time.cast("timestamp")) / 1_000_000)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    start: str,
    end: str,
    open_until: Column | None = None,
    how: str = "inner",
    buckets: tuple[int, ...] = BUCKETS,
) -> DataFrame:
    """Each point with each interval of its key that holds it, both ends included; each pair once.

    The result has the columns of ``points`` and those of ``intervals`` but the key; other names
    must differ. Points and intervals without a key, time or start match nothing, nor do those
    that end before they start; an interval without an end lasts to ``open_until``, or matches nothing. ``how="left"``
    keeps points without an interval.

    An interval belongs to the first level whose buckets are as long as it is, and so touches
    two buckets at most; a point asks one bucket of each level that occurs. The join is on key, level and bucket,
    which adaptive execution can split, and the exact condition comes with it.
    """
    until = F.coalesce(F.col(end), open_until) if open_until is not None else F.col(end)
    held = intervals.withColumns({"_from": F.col(start), "_to": until, "_key": F.col(key)}).drop(key)
    held = held.filter(F.col("_key").isNotNull() & (F.col("_from") <= F.col("_to")))
    length = _seconds(F.col("_to")) - _seconds(F.col("_from"))
    level = F.lit(len(buckets) - 1)
    for i, size in reversed(list(enumerate(buckets[:-1]))):
        level = F.when(length < size, i).otherwise(level)
    held = held.withColumn("_level", level)
    levels = sorted(r[0] for r in held.select("_level").distinct().collect())
    size = F.get(F.lit(list(buckets)), F.col("_level"))
    touched = F.sequence(F.floor(_seconds(F.col("_from")) / size), F.floor(_seconds(F.col("_to")) / size))
    held = held.select("*", F.explode(touched).alias("_bucket"))
    asking = [
        F.struct(F.lit(i).alias("level"), F.floor(_seconds(F.col(time)) / buckets[i]).alias("bucket")) for i in levels
    ]
    condition = (
        (F.col(key) == F.col("_key"))
        & (F.col("_ask.level") == F.col("_level"))
        & (F.col("_ask.bucket") == F.col("_bucket"))
        & F.col(time).between(F.col("_from"), F.col("_to"))
    )
    kept = [*points.columns, *[c for c in intervals.columns if c != key]]
    if how == "inner":
        asked = points.select("*", F.explode(F.array(*asking)).alias("_ask")) if levels else points.withColumn("_ask", F.lit(None).cast("struct<level:int,bucket:bigint>"))
        return asked.join(held, condition).select(kept)
    # A point without a match must come out once, not once a level: its own row, written with a number, joined to its pairs.
    numbered = materialize(points.withColumn("_place", F.monotonically_increasing_id()), "points")
    pairs = interval_join(numbered, intervals, key, time, start, end, open_until, "inner", buckets)
    return numbered.join(pairs.drop(*points.columns), "_place", "left").select(kept)
