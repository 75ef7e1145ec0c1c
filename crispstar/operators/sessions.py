"""Sessions and runs: neighbouring rows of a key that belong together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.operators.ordered import BLOCK_ROWS, in_blocks, last_known, running_sum
from crispstar.session import materialize


def numbered_sessions(events: DataFrame, key: str, time: str, gap: str, name: str = "session_no", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Events with the number of their session: a session ends where nothing follows within a ``gap`` such as ``30 minutes``.

    An event at exactly ``gap`` after the last one still belongs to its session, as with ``session_window``.
    Events without key or time belong to no session and are left out; ``sessions`` says what to do with them.
    Numbers ascend with key and time over the whole table. The event before
    is sought in the order of all rows, so a key with any number of events is cut into blocks.
    """
    timed = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    blocks = in_blocks(timed, [key, time], block_rows)
    seen = last_known(blocks, F.struct(F.col(key).alias("key"), F.col(time).alias("time")), "_before", up_to=-1)
    goes_on = (F.col("_before.key") == F.col(key)) & (F.col(time) <= F.col("_before.time") + F.expr(f"INTERVAL {gap}"))
    begins = seen.withColumn("_begins", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).drop("_before")
    return running_sum(begins, F.col("_begins"), name).select(*events.columns, name)


def sessions(events: DataFrame, key: str, time: str, gap: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per session: ``key, session_start, session_end`` (the last event)``, events``.

    Events without key or time are in none: count them with ``key_null_count``, or keep them with ``undated_events``.
    """
    numbered = numbered_sessions(events, key, time, gap, "_session", block_rows)
    ends = numbered.groupBy("_session", key).agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count("*").alias("events")
    )
    return ends.drop("_session")


def change_history(rows: DataFrame, key: str, order_by: list[str], values: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Runs of equal values of each key: ``key, run, values, valid_from, valid_to, rows``.

    Rows of a key follow each other by ``order_by``, of which the first column dates a run;
    NULL comes first and other columns settle ties. Neighbours with equal values, NULL equal to NULL, are one run,
    numbered from 1. ``valid_to`` is where the next run of the key begins, NULL for the last. NULL is a key of its own.

    Rows before and after are sought in the order of all rows, so a key may have any number.
    """
    blocks = in_blocks(rows, [key, *order_by], block_rows)
    state = F.struct(F.col(key).alias("key"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    seen = last_known(blocks, state, "_before", up_to=-1)
    same = F.col("_before").isNotNull() & F.col("_before.key").eqNullSafe(F.col(key))
    for i, v in enumerate(values):
        same &= F.col(f"_before.v{i}").eqNullSafe(F.col(v))
    fresh = F.when(F.col("_before").isNotNull() & F.col("_before.key").eqNullSafe(F.col(key)), 0).otherwise(1)
    flagged = seen.withColumns({"_begins": F.when(same, 0).otherwise(1), "_fresh": fresh}).drop("_before")
    numbered = running_sum(flagged, F.col("_begins"), "_run")
    runs = materialize(
        numbered.groupBy("_run").agg(
            *[F.min_by(c, "_place").alias(c) for c in (key, *values)],
            F.min_by(order_by[0], "_place").alias("valid_from"),
            F.max("_fresh").alias("_fresh"),
            F.count("*").alias("rows"),
        ),
        "runs",
    )
    following = runs.select((F.col("_run") - 1).alias("_run"), F.col("valid_from").alias("_next"), F.col("_fresh").alias("_ends"))
    # The first run of each key, carried on to the others of the key.
    firsts = last_known(in_blocks(runs, ["_run"], block_rows), F.when(F.col("_fresh") == 1, F.col("_run")), "_first")
    joined = firsts.join(following, "_run", "left")
    return joined.select(
        key,
        (F.col("_run") - F.col("_first") + 1).alias("run"),
        *values,
        "valid_from",
        F.when(F.col("_ends") == 0, F.col("_next")).alias("valid_to"),
        "rows",
    )
