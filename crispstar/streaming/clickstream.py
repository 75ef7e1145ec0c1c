"""Clickstream files as a stream: the batch cleaning, then unique events, counts per closed window, and sessions.

Every state has a watermark and so forgets; a window or session is written once, when nothing can change
it any more. Output is appended by the file sink, whose log makes a batch's files visible together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crispstar.plans.silver import silver_clickstream
from crispstar.sources.schemas import CLICKSTREAM


def silver_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder, cleaned by the same projection as the batch table."""
    reader = spark.readStream.schema(CLICKSTREAM)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return silver_clickstream(reader.parquet(folder))


def timed(events: DataFrame, time: str, delay: str) -> DataFrame:
    """The rows that have a time, with a watermark on it. A watermark needs a timestamp with a zone."""
    return events.filter(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def unique_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per event id among events no further apart than the delay.

    The state holds the ids of the last ``delay`` only. An event without a time cannot be placed:
    ``undated_events`` has those.
    """
    return timed(events, "timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def undated_events(events: DataFrame) -> DataFrame:
    """The events that ``unique_events`` leaves out, each as it came; write them beside it."""
    return events.filter(F.col("timestamp").isNull())


def event_counts(events: DataFrame, window: str = "1 day") -> DataFrame:
    """Events per tumbling window and type. Rows later than the watermark are dropped."""
    slot = F.window("timestamp", window)
    counted = events.groupBy(slot, "event_type").agg(F.count("*").alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "events")


def stream_sessions(events: DataFrame, key: str = "customer_id", time: str = "timestamp", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """``operators.sessions.sessions`` as a stream: a session is a row once the watermark has passed its end and the gap.

    Events later than the watermark are dropped, so they neither make nor prolong a session.
    """
    known = timed(events.filter(F.col(key).isNotNull()), time, delay)
    grouped = known.groupBy(key, F.session_window(time, gap))
    ended = grouped.agg(F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count("*").alias("events"))
    return ended.drop("session_window")


def append(rows: DataFrame, folder: str, state: str) -> StreamingQuery:
    """Append a stream to a folder of Parquet files until the input is used up; the state is kept for the next run."""
    writer = rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", state)
    return writer.outputMode("append").trigger(availableNow=True).start()


def write_counts(events: DataFrame, folder: str, state: str, window: str = "1 day", delay: str = "1 hour") -> StreamingQuery:
    """Count each event once and append a row per window and type when the watermark has closed the window.

    The state holds the ids of the last ``delay`` and the open windows. ``late_rows`` of the
    query counts the events that came later than that; undated events are written by ``append(undated_events(...))``.
    """
    return append(event_counts(unique_events(events, delay), window), folder, state)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a finished query dropped because the watermark had passed them."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows that a finished query keeps in its state."""
    last = query.lastProgress
    return sum(op["numRowsTotal"] for op in last["stateOperators"]) if last else 0
