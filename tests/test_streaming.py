"""The stream gives what the batch gives."""

import datetime as dt

from pyspark.sql import functions as F

from crispstar.operators import sessions, time_joins
from crispstar.plans.silver import silver_clickstream
from crispstar.streaming import append, event_counts, followed_by, late_rows, silver_stream, state_rows, stream_sessions, unique_events, write_counts
from registry.tables import Layers
from tests.conftest import SMALL, rows


def drain(df, folder, name):
    out = f"{folder}/{name}"
    query = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_cleaning_is_the_same(spark, tmp_path):
    bronze = Layers(spark, SMALL).bronze("clickstream")
    bronze.repartition(4).write.parquet(f"{tmp_path}/in")
    streamed = drain(silver_stream(spark, f"{tmp_path}/in", 1), tmp_path, "silver")
    assert rows(streamed) == rows(silver_clickstream(bronze))


def event(i, ts, kind="click"):
    return (f"E{i}", "S", "C", kind, "/p", "D", ts, "run")


def files(spark, folder, *batches):
    from crispstar.sources.schemas import CLICKSTREAM

    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, CLICKSTREAM).coalesce(1).write.mode("append").parquet(folder)


def test_repeated_events_are_dropped_across_files(spark, tmp_path):
    folder = f"{tmp_path}/in"
    files(
        spark, folder,
        [event(1, "2024-01-01 10:00:00"), event(2, "2024-01-01 10:10:00"), event(3, None)],
        [event(1, "2024-01-01 10:00:00"), event(4, "2024-01-01 10:20:00")],
    )
    got = drain(unique_events(silver_stream(spark, folder, 1)), tmp_path, "unique")
    assert [r[0] for r in rows(got.select("event_id"))] == ["E1", "E2", "E4"]


def test_windows_close_at_the_watermark_and_late_rows_drop(spark, tmp_path):
    folder = f"{tmp_path}/in"
    files(spark, folder, [event(1, "2024-01-01 10:00:00"), event(2, "2024-01-01 10:30:00", "view")])
    counted = event_counts(unique_events(silver_stream(spark, folder, 1)), "1 hour")
    assert rows(drain(counted, tmp_path, "counts")) == []
    files(spark, folder, [event(3, "2024-01-01 14:00:00")])
    drain(counted, tmp_path, "counts")
    files(spark, folder, [event(4, "2024-01-01 10:45:00"), event(5, "2024-01-01 18:00:00")])
    got = drain(counted, tmp_path, "counts")
    start = F.col("window_start").cast("timestamp_ntz")
    ten, two = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 14)
    assert rows(got.select(start, "event_type", "events")) == [(ten, "Click", 1), (ten, "View", 1), (two, "Click", 1)]


def test_counts_equal_batch_counts(spark):
    silver = silver_clickstream(Layers(spark, SMALL).bronze("clickstream")).filter("timestamp is not null")
    counted = event_counts(silver.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    assert counted.agg(F.sum("events")).first()[0] == silver.count()


FAR = "2100-01-01 00:00:00"


def test_a_closed_window_is_written_once_and_late_events_are_counted(spark, tmp_path):
    folder, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    late, kept = 0, []
    batches = [
        [event(i, f"2024-01-01 {10 + i // 30}:{i % 30:02}:00") for i in range(90)] + [event(0, "2024-01-01 10:00:00")],
        [event(200, "2024-01-01 10:30:00"), event(201, "2024-01-01 12:10:00"), event(202, None)],
        [event("closing", FAR)],
    ]
    for batch in batches:
        files(spark, folder, batch)
        query = write_counts(silver_stream(spark, folder), out, state, "1 hour", "1 hour")
        query.awaitTermination()
        late += late_rows(query)
        kept.append(state_rows(query))
    got = spark.read.parquet(out).select(F.date_format("window_start", "HH"), "events")
    assert rows(got) == [("10", 30), ("11", 30), ("12", 31)] and late == 1
    # Two runs later nothing is left but the closing event's id and window.
    assert kept[0] > 30 and kept[-1] == 2


def test_sessions_of_a_stream_equal_those_of_the_batch(spark, tmp_path):
    folder, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    bronze = Layers(spark, SMALL).bronze("clickstream")
    bronze.write.parquet(folder)
    files(spark, folder, [event("closing", FAR)])
    append(stream_sessions(silver_stream(spark, folder), gap="3 hours"), out, state).awaitTermination()
    got = spark.read.parquet(out)
    got = got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    assert rows(got) == rows(sessions.sessions(silver_clickstream(bronze), "customer_id", "timestamp", "3 hours"))


def stream_of(spark, folder, schema, *batches):
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_two_streams_joined_forget_and_agree_with_the_batch(spark, tmp_path):
    def at(minute):
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)

    far = dt.datetime(2100, 1, 1)
    clicks = [(i, "a" if i % 3 else None, at(i * 7)) for i in range(120)]
    tickets = [(i, "a" if i % 4 else "b", at(i * 11)) for i in range(80)] + [(900, None, at(5))]
    schema = ("n long, key string, clicked timestamp_ntz", "m long, key string, opened timestamp_ntz")
    left = stream_of(spark, f"{tmp_path}/c", schema[0], clicks[:60], clicks[60:], [(-1, "z", far)])
    right = stream_of(spark, f"{tmp_path}/t", schema[1], tickets[:40], tickets[40:], [(-1, "z", far)])
    query = append(followed_by(left, right, "key", "clicked", "opened", "20 minutes", "5 hours"), f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").filter("n >= 0").select("n", "m")
    want = [(n, m) for n, k, c in clicks for m, j, o in tickets if k and k == j and c <= o <= c + dt.timedelta(minutes=20)]
    met = {n for n, _ in want}
    want += [(n, None) for n, _, _ in clicks if n not in met]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # Only the closing rows can still find a match.
    assert state_rows(query) <= 4
    batch = time_joins.interval_join(
        spark.createDataFrame(tickets, schema[1]), spark.createDataFrame([(*c, c[2] + dt.timedelta(minutes=20)) for c in clicks], schema[0] + ", until timestamp_ntz"),
        "key", "opened", "clicked", "until",
    )
    assert rows(batch.select("n", "m")) == rows(got.filter("m is not null"))
