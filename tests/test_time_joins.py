"""As-of joins, interval joins, sessions and change history against plain Python."""

import datetime as dt
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crispstar.operators import sessions, time_joins
from crispstar.session import materialize
from tests.conftest import final_plan, rows

T0 = dt.datetime(2024, 1, 1)
GAP = "30 minutes"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=int(minutes))


def made(seed, n, keys="aaaaaabc", span=600):
    """Rows of (n, key, time): one key has most rows, some lack a key or a time, many share a time."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        key = None if rng.random() < 0.05 else str(rng.choice(list(keys)))
        out.append((i, key, at(None if rng.random() < 0.05 else rng.integers(0, span))))
    return out


def frame(spark, found, names="n long, key string, time timestamp_ntz"):
    return spark.createDataFrame(found, names).repartition(4)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 40])
def test_as_of_join(spark, strict, tolerance):
    left, right = made(1, 300), made(2, 120)
    asked = frame(spark, left)
    offered = frame(spark, right, "m long, key string, since timestamp_ntz")
    limit = None if tolerance is None else f"{tolerance} minutes"
    got = time_joins.as_of_join(asked, offered, "key", "time", "since", {"found": "m", "found_at": "since"}, strict, limit, block_rows=16)
    want = []
    for n, key, time in left:
        earlier = [(t, m) for m, k, t in right if None not in (k, key, t, time) and k == key and (t < time or t == time and not strict)]
        best = max(earlier, default=(None, None))
        if best[0] and tolerance is not None and time - best[0] > dt.timedelta(minutes=tolerance):
            best = (None, None)
        want.append((n, key, time, best[1], best[0]))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_as_of_join_with_nothing(spark):
    left, none = frame(spark, made(1, 10)), frame(spark, made(1, 10)).limit(0)
    take = {"found": "n"}
    assert time_joins.as_of_join(left, none, "key", "time", "time", take).filter("found is null").count() == 10
    assert time_joins.as_of_join(none, left, "key", "time", "time", take).count() == 0


def test_as_of_join_cuts_a_hot_key(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    hot = spark.range(8000, numPartitions=4).select(
        "id", F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") % 500).cast("timestamp_ntz").alias("time")
    )
    joined = time_joins.as_of_join(hot, hot.filter("id % 7 = 0"), "key", "time", "time", {"found": "id"}, block_rows=500)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 4000
    text = final_plan(joined)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def ticket_rows(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for m, key, time in made(seed, n):
        length = int(rng.choice([-5, 0, 3, 50, 90, 4000, 60 * 24 * 90]))
        out.append((m, key, time, None if rng.random() < 0.1 or time is None else time + dt.timedelta(minutes=length)))
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("still_open", [None, dt.datetime(2024, 1, 2)])
def test_interval_join(spark, how, still_open):
    points, intervals = made(3, 200, span=5000), ticket_rows(4, 80)
    left = frame(spark, points)
    right = frame(spark, intervals, "m long, key string, since timestamp_ntz, until timestamp_ntz")
    until = None if still_open is None else F.lit(still_open).cast("timestamp_ntz")
    got = time_joins.interval_join(left, right, "key", "time", "since", "until", until, how)
    want = Counter()
    for n, key, time in points:
        met = [
            (m, s, e) for m, k, s, e in intervals
            if None not in (key, k, time, s, e or still_open) and k == key and s <= time <= (e or still_open) and s <= (e or still_open)
        ]
        for found in met or ([(None,) * 3] if how == "left" else []):
            want[n, key, time, *found] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_interval_join_plan_and_hot_key(spark, settings):
    settings(spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = frame(spark, made(5, 100)), frame(spark, ticket_rows(6, 50), "m long, key string, since timestamp_ntz, until timestamp_ntz")
    text = final_plan(time_joins.interval_join(left, right, "key", "time", "since", "until"))
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_interval_join_with_nothing(spark):
    left = frame(spark, made(5, 10))
    right = frame(spark, ticket_rows(6, 5), "m long, key string, since timestamp_ntz, until timestamp_ntz").limit(0)
    assert time_joins.interval_join(left, right, "key", "time", "since", "until").count() == 0
    assert time_joins.interval_join(left, right, "key", "time", "since", "until", how="left").count() == 10
    assert time_joins.interval_join(left.limit(0), right, "key", "time", "since", "until", how="left").count() == 0


def brute_sessions(found, gap):
    by_key = defaultdict(list)
    for _, key, time in found:
        if key is not None and time is not None:
            by_key[key].append(time)
    out = []
    for key, times in by_key.items():
        times.sort()
        held = [times[0]]
        for t in [*times[1:], None]:
            if t is None or t > held[-1] + dt.timedelta(minutes=gap):
                out.append((key, held[0], held[-1], len(held)))
                held = []
            held.append(t)
    return Counter(out)


@pytest.mark.parametrize("block_rows", [1, 7, 1 << 16])
def test_sessions(spark, block_rows):
    found = made(7, 250, span=4000)
    got = sessions.sessions(frame(spark, found), "key", "time", GAP, block_rows)
    assert Counter(map(tuple, got.collect())) == brute_sessions(found, 30)


def test_sessions_agree_with_session_window(spark):
    found = frame(spark, made(8, 300, span=4000))
    ours = sessions.sessions(found, "key", "time", GAP)
    theirs = (
        found.filter("key is not null and time is not null").groupBy("key", F.session_window(F.col("time").cast("timestamp"), "30 minutes"))
        .agg(F.min("time").alias("session_start"), F.max("time").alias("session_end"), F.count("*").alias("events")).drop("session_window")
    )
    assert rows(ours) == rows(theirs) and rows(ours)


def test_a_session_of_one_hot_key_spans_blocks(spark):
    hot = spark.range(3000, numPartitions=3).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("time"))
    assert sessions.sessions(hot, "key", "time", GAP, 100).collect()[0]["events"] == 3000


@pytest.mark.parametrize("block_rows", [1, 5, 1 << 16])
def test_change_history(spark, block_rows):
    rng = np.random.default_rng(9)
    found = [(n, k, t, None if rng.random() < 0.2 else int(rng.integers(0, 2)), str(rng.choice(["x", "y"]))) for n, k, t in made(10, 200, "aab")]
    df = frame(spark, found, "n long, key string, time timestamp_ntz, level int, kind string")
    got = sessions.change_history(df, "key", ["time", "n"], ["level", "kind"], block_rows)
    by_key = defaultdict(list)
    for n, key, time, *values in found:
        by_key[key].append((time is not None, time or T0, n, tuple(values)))
    want = Counter()
    for key, listed in by_key.items():
        runs = []
        for dated, time, _, values in sorted(listed, key=lambda r: r[:3]):
            if runs and runs[-1][0] == values:
                runs[-1][2] += 1
            else:
                runs.append([values, time if dated else None, 1])
        for i, (values, begin, n) in enumerate(runs):
            want[key, i + 1, *values, begin, runs[i + 1][1] if i + 1 < len(runs) else None, n] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_change_history_of_nothing(spark):
    none = materialize(frame(spark, made(1, 5)).limit(0), "none")
    assert sessions.change_history(none, "key", ["time"], ["n"]).count() == 0
    assert sessions.sessions(none, "key", "time", GAP).count() == 0
