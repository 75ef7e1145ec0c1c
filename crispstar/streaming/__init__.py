"""Clickstream and tickets as streams."""

from crispstar.streaming.clickstream import (
    append,
    event_counts,
    late_rows,
    silver_stream,
    state_rows,
    stream_sessions,
    undated_events,
    unique_events,
    write_counts,
)
from crispstar.streaming.joins import followed_by

__all__ = [
    "append",
    "event_counts",
    "followed_by",
    "late_rows",
    "silver_stream",
    "state_rows",
    "stream_sessions",
    "undated_events",
    "unique_events",
    "write_counts",
]
