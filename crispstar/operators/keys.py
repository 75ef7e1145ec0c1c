"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crispstar.operators.columns import by, rest_of
from crispstar.session import materialize

# monotonically_increasing_id holds the partition above bit 33 and the row below.
ROW_BITS = 33


def surrogate_key(df: DataFrame, order_by: list[str], name: str, unique_rows: bool = False) -> DataFrame:
    """Put a 1..n key in front of the columns, in the order of ``order_by``.

    A window without partitions would sort the table in one task. Here the rows
    are range-partitioned and sorted, each row is stamped with its partition and
    place, and the stamped table is written once, so the stamps stay fixed even
    when an executor is lost. A row's key is its place plus the number of rows in
    the partitions before it.

    Remaining columns settle ties, and the input position separates identical
    rows, so neither a hot key nor a group of copies has to fit in one task. A
    task that runs again must find its rows in the same positions, which holds
    for a scan and for sorted input; say ``unique_rows`` when no two rows are
    identical, and positions are not used at all.
    """
    order = [by(c) for c in (*order_by, *rest_of(df, *order_by))]
    placed = df if unique_rows else df.withColumn("_tie", F.monotonically_increasing_id())
    cuts = order if unique_rows else [*order, F.col("_tie")]
    stamped = (
        placed.repartitionByRange(*cuts)
        .sortWithinPartitions(*cuts)
        .withColumn("_stamp", F.monotonically_increasing_id())
        .drop("_tie")
    )
    table = materialize(stamped, name)
    partition = F.shiftright("_stamp", ROW_BITS)
    # One row per shuffle partition, numbered by a running sum, written once and broadcast.
    sizes = table.groupBy(partition.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")), "starts")
    place = F.col("_stamp").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    numbered = table.join(F.broadcast(starts), partition == F.col("_part"))
    return numbered.select((F.col("_before") + place).alias(name), *df.columns)
