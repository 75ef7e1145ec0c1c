"""Samples, previews, present time, calendars, key offsets, scratch folders."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from crispstar.operators import rules, values
from crispstar.operators.keys import surrogate_key
from crispstar.plans import gold
from crispstar.session import scratch_dir
from tests.conftest import plan, rows


def test_a_whole_sample_has_every_row_and_needs_no_limit(spark):
    df = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id")))
    assert values.sample_rows(df, 100, None, "key").count() == 3000
    half = values.sample_rows(df, 50, None, "key", seed=4)
    assert 1300 < half.count() < 1700
    assert 400 < half.filter("key IS NULL").count() < 600
    assert "Sort" not in plan(half)


def test_a_preview_without_order_does_not_sort(spark):
    df = spark.range(100)
    assert values.preview(df, 5).count() == 5
    assert "Sort" not in plan(values.preview(df, 5)) and "TakeOrdered" not in plan(values.preview(df, 5))
    assert rows(values.preview(df, 2, ("id",))) == [(0,), (1,)]


def test_present_time_splits_today(spark):
    now = "localtimestamp() {} interval 1 minute"
    df = spark.sql(f"SELECT {now.format('-')} AS a, 'past' AS k UNION ALL SELECT {now.format('+')}, 'future'")
    assert [r.k for r in rules.future_dates(df, ["a"]).collect()] == ["future"]
    zoned = df.withColumn("a", F.col("a").cast("timestamp"))
    assert [r.k for r in rules.future_dates(zoned, ["a"]).collect()] == ["future"]
    text = df.withColumn("a", F.date_format("a", "yyyy-MM-dd HH:mm:ss"))
    parse = lambda c: F.col(c).cast("timestamp_ntz")
    assert [r.k for r in rules.future_dates(text, ["a"], parser=parse).collect()] == ["future"]


def test_the_size_of_a_calendar_grows_with_its_days(spark):
    def size(days):
        dates = gold.dim_date(spark, dt.date(2000, 1, 1), dt.date(2000, 1, 1) + dt.timedelta(days - 1))
        assert dates.count() == days
        return dates._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()

    assert size(100_000) > 500 * size(100)
    span = spark.sql("SELECT DATE '2024-02-28' AS start_date, DATE '2024-03-01' AS end_date")
    assert [r.date_key for r in gold.dim_date_between(span).orderBy("date_key").collect()] == [20240228, 20240229, 20240301]
    with pytest.raises(ValueError, match="3 days"):
        gold.dim_date_between(span, longest=2)
    assert gold.dim_date_between(spark.sql("SELECT CAST(NULL AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date")).count() == 0


def test_key_offsets_are_not_part_of_the_plan(spark, settings):
    settings(spark__sql__shuffle__partitions="400", spark__sql__adaptive__coalescePartitions__enabled="false")
    keyed = surrogate_key(spark.range(20_000).repartition(8), ["id"], "key", unique_rows=True)
    begun = time.time()
    assert len(plan(keyed)) < 10_000 and time.time() - begun < 2
    assert keyed.filter(F.col("key") != F.col("id") + 1).isEmpty()


def test_no_folder_of_one_machine(monkeypatch):
    class Context:
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError):
        scratch_dir(Session)
