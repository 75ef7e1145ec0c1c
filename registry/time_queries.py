"""Queries over time: joins, sessions, histories and streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.operators import sessions, time_joins
from crispstar.plans import silver
from crispstar.session import scratch_path
from crispstar.sources.schemas import CLICKSTREAM, TICKETS
from crispstar.streaming import (
    append,
    followed_by,
    late_rows,
    silver_stream,
    stream_sessions,
    undated_events,
    write_counts,
)
from registry.tables import Layers

GAP = "6 hours"
FAR = "2100-01-01 00:00:00"


def _clicks(t: Layers) -> DataFrame:
    return t.silver("clickstream").select("event_id", "customer_id", "timestamp")


def _tickets(t: Layers) -> DataFrame:
    return t.silver("tickets").select("ticket_id", "customer_id", "issue_type", "ticket_created", "ticket_resolved")


def _as_of_ticket(t: Layers, **how) -> DataFrame:
    """Each event with the latest ticket that its customer had opened by then."""
    take = {c: c for c in ("ticket_id", "issue_type", "ticket_created")}
    return time_joins.as_of_join(_clicks(t), _tickets(t), "customer_id", "timestamp", "ticket_created", take, **how)


def _events_during_tickets(t: Layers) -> DataFrame:
    """Each event with every ticket of its customer that was open then; tickets that are never resolved are still open."""
    tickets = _tickets(t).drop("issue_type")
    until = F.lit(FAR).cast("timestamp_ntz")
    return time_joins.interval_join(_clicks(t), tickets, "customer_id", "timestamp", "ticket_created", "ticket_resolved", until)


def _tickets_after_clicks(t: Layers) -> DataFrame:
    """Each dated event with the tickets that its customer opened within the hour after it, or none."""
    tickets = _tickets(t).select("ticket_id", F.col("customer_id").alias("opened_by"), "ticket_created")
    clicks = _clicks(t).filter(F.col("timestamp").isNotNull())
    hour = clicks.withColumn("until", F.col("timestamp") + F.expr("INTERVAL 1 HOUR"))
    met = time_joins.interval_join(tickets, hour.withColumnRenamed("customer_id", "opened_by"), "opened_by", "ticket_created", "timestamp", "until")
    pairs = met.select("event_id", "ticket_id", "ticket_created")
    # One row an event: the ids of clickstream events are unique.
    return clicks.join(pairs, "event_id", "left").select("event_id", "customer_id", "timestamp", "ticket_id", "ticket_created")


def _status_history(t: Layers) -> DataFrame:
    """What an order's status and payment method were, and from when to when, from all rows of its id."""
    orders = t.silver("orders").select("order_id", "order_date", "status", "payment_method", "order_amount")
    return sessions.change_history(orders, "order_id", ["order_date"], ["status", "payment_method"])


def _closing(t: Layers, schema, **values: str) -> DataFrame:
    """A row far ahead, whose time moves the watermark past all others."""
    return t.spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)


def _arrivals(path: str, *batches: DataFrame) -> Iterator[None]:
    """Put one batch after the other into the folder that a stream reads."""
    for batch in batches:
        batch.write.mode("append").parquet(path)
        yield


def _last_event(t: Layers) -> DataFrame:
    return _closing(t, CLICKSTREAM, event_id="closing", customer_id="closing", timestamp=FAR)


def _untimed(df: DataFrame) -> DataFrame:
    """Instants as wall clock times, which is what they were before the stream."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"})


def _stream_clickstream(t: Layers) -> DataFrame:
    """Files in, cleaned; each event counted once per day and type when its day is closed."""
    source, sink, state = (scratch_path(t.spark, f"stream-{x}") for x in ("in", "out", "state"))
    for _ in _arrivals(source, t.bronze("clickstream").repartition("event_id"), _last_event(t)):
        write_counts(silver_stream(t.spark, source), sink, state).awaitTermination()
    return _untimed(t.spark.read.parquet(sink))


def _stream_window_counts(t: Layers) -> DataFrame:
    """Counts per closed day and type; beside them the events that came too late, and the undated ones by type.

    Every event whose id ends in 97 arrives after all others, so those a day older than the newest are late.
    """
    source, sink, state, undated, seen = (scratch_path(t.spark, f"windows-{x}") for x in ("in", "out", "state", "undated", "seen"))
    raw = t.bronze("clickstream")
    held_back = F.col("event_id").endswith("97")
    late = 0
    for _ in _arrivals(source, raw.filter(~held_back), raw.filter(held_back), _last_event(t)):
        query = write_counts(silver_stream(t.spark, source), sink, state, delay="1 day")
        query.awaitTermination()
        late += late_rows(query)
    append(undated_events(silver_stream(t.spark, source)), undated, seen).awaitTermination()
    counted = _untimed(t.spark.read.parquet(sink)).withColumn("kind", F.lit("closed"))
    never = F.lit(None).cast("timestamp_ntz").alias("window_start")
    without = t.spark.read.parquet(undated).groupBy("event_type").agg(F.count("*").alias("events"))
    dropped = t.spark.range(1).select(never, F.lit(None).cast("string").alias("event_type"), F.lit(late).cast("long").alias("events"), F.lit("late").alias("kind"))
    return counted.unionByName(without.select(never, "event_type", "events", F.lit("undated").alias("kind"))).unionByName(dropped)


def _stream_sessions(t: Layers) -> DataFrame:
    """The sessions of the batch query, written as they end."""
    source, sink, state = (scratch_path(t.spark, f"sessions-{x}") for x in ("in", "out", "state"))
    raw = t.bronze("clickstream")
    for _ in _arrivals(source, raw, _last_event(t)):
        append(stream_sessions(silver_stream(t.spark, source), gap=GAP), sink, state).awaitTermination()
    return _untimed(t.spark.read.parquet(sink))


def _stream_tickets_after_clicks(t: Layers) -> DataFrame:
    """``tickets_after_clicks`` as two streams, joined while they arrive."""
    clicks, tickets, sink, state = (scratch_path(t.spark, f"followed-{x}") for x in ("clicks", "tickets", "out", "state"))
    last_ticket = _closing(t, TICKETS, ticket_id="closing", customer_id="closing", ticket_created=FAR)
    first, second = t.bronze("clickstream"), t.bronze("tickets")
    # In two parts and the closing rows; the newest of all come last.
    newest = "2024-01-15"
    arriving = zip(
        _arrivals(clicks, first.filter(F.coalesce(F.col("timestamp"), F.lit("")) < newest), first.filter(F.col("timestamp") >= newest), _last_event(t)),
        _arrivals(tickets, second.filter(F.coalesce(F.col("ticket_created"), F.lit("")) < newest), second.filter(F.col("ticket_created") >= newest), last_ticket),
    )
    opened = silver.silver_tickets(t.spark.readStream.schema(TICKETS).parquet(_made(tickets, second))).select("ticket_id", "customer_id", "ticket_created")
    events = silver_stream(t.spark, _made(clicks, first)).select("event_id", "customer_id", "timestamp")
    for _ in arriving:
        joined = followed_by(events, opened, "customer_id", "timestamp", "ticket_created", delay="40 days")
        append(joined, sink, state).awaitTermination()
    found = _untimed(t.spark.read.schema(joined.schema).parquet(sink))
    return found.filter(F.col("timestamp") < F.lit(FAR).cast("timestamp_ntz"))


def _made(path: str, like: DataFrame) -> str:
    """A folder that a stream can read from the beginning: with a file of no rows."""
    like.limit(0).write.parquet(path)
    return path


QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    "as_of_ticket": _as_of_ticket,
    "as_of_ticket_of_the_day": lambda t: _as_of_ticket(t, strict=True, tolerance="1 day"),
    "events_during_tickets": _events_during_tickets,
    "tickets_after_clicks": _tickets_after_clicks,
    "customer_sessions": lambda t: sessions.sessions(_clicks(t), "customer_id", "timestamp", GAP),
    "status_history": _status_history,
    "stream_clickstream": _stream_clickstream,
    "stream_window_counts": _stream_window_counts,
    "stream_sessions": _stream_sessions,
    "stream_tickets_after_clicks": _stream_tickets_after_clicks,
}
