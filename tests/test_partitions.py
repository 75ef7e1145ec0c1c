"""Tables in partitions: what is read, what is rewritten."""

from pathlib import Path

from pyspark.sql import functions as F

from crispstar.operators import incremental
from crispstar.operators.incremental import incremental_load, load_partitions, recover_partitions
from crispstar.plans import gold, kpi
from crispstar.sources import tables
from crispstar.streaming import silver_stream, undated_events
from registry.tables import Layers
from tests.conftest import SMALL, plan, rows
from tests.test_streaming import event, files


def test_the_newest_row_wins_on_either_side(spark):
    schema = "k string, v int, at int"
    table = spark.createDataFrame([("a", 1, 5), ("b", 1, 1), ("c", 1, None), ("d", 1, 1), (None, 1, 9)], schema)
    batch = spark.createDataFrame(
        [("a", 2, 4), ("b", 2, 1), ("b", 3, 0), ("c", 2, None), ("e", 2, 1), (None, 2, 3)], schema
    )
    got = rows(incremental_load(table, batch, "k", newest_by="at"))
    assert got == [(None, 1, 9), ("a", 1, 5), ("b", 2, 1), ("c", 2, None), ("d", 1, 1), ("e", 2, 1)]


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    schema, path = "k int, v int, part string", str(tmp_path / "t")
    spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 1, "y"), (4, 1, None)], schema).write.partitionBy("part").parquet(path)

    def found(part):
        return sorted(f.name for f in Path(path, f"part={part}").glob("*.parquet"))

    before = {part: found(part) for part in ("x", "y", "__HIVE_DEFAULT_PARTITION__")}
    load_partitions(spark, path, spark.createDataFrame([(1, 2, "x"), (5, 2, "x"), (6, 2, "z"), (4, 2, None)], schema), "k", "part")
    assert found("y") == before["y"] and found("x") != before["x"] and found("z")
    assert found("__HIVE_DEFAULT_PARTITION__") != before["__HIVE_DEFAULT_PARTITION__"]
    got = rows(spark.read.schema(schema).parquet(path).select("k", "v", "part"))
    assert got == [(1, 2, "x"), (2, 1, "x"), (3, 1, "y"), (4, 2, None), (5, 2, "x"), (6, 2, "z")]
    load_partitions(spark, path, spark.createDataFrame([], schema), "k", "part")
    assert rows(spark.read.schema(schema).parquet(path).select("k", "v", "part")) == got


def test_a_year_of_a_fact_reads_its_partitions(spark, tmp_path):
    layers = Layers(spark, SMALL)
    fact = gold.with_month(layers.orders_once())
    stored = tables.publish(fact, str(tmp_path / "fact"), partition_by="date_month")
    assert stored.columns == fact.columns and rows(stored) == rows(fact)
    year = kpi.revenue_trend(gold.in_years(stored, 2014, 2014), layers.dim_date)
    assert "PartitionFilters: [isnotnull(date_month" in plan(year) and "201401" in plan(year)
    whole = kpi.revenue_trend(stored, layers.dim_date)
    assert rows(year) == rows(whole.filter("year = 2014"))


def test_undated_events_are_kept_beside(spark, tmp_path):
    files(spark, f"{tmp_path}/in", [event(1, "2024-01-01 10:00:00"), event(2, None), event(2, None)])
    out = undated_events(silver_stream(spark, f"{tmp_path}/in"))
    writer = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/s")
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out")
    assert rows(got.select("event_id", F.col("timestamp").isNull())) == [("E2", True), ("E2", True)]


SCHEMA = "k int, v int, part string"


def stored(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path).select("k", "v", "part"))


def test_a_key_may_change_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 1, "a b/c"), (4, 1, None), (5, 1, "z")], SCHEMA).write.partitionBy("part").parquet(path)
    load_partitions(spark, path, spark.createDataFrame([(1, 2, "y"), (3, 2, "y"), (4, 2, "z")], SCHEMA), "k", "part")
    # Two partitions are emptied by it, and gone.
    assert stored(spark, path) == [(1, 2, "y"), (2, 1, "x"), (3, 2, "y"), (4, 2, "z"), (5, 1, "z")]
    assert sorted(f.name for f in Path(path).iterdir() if f.name.startswith("part=")) == ["part=x", "part=y", "part=z"]
    older = spark.createDataFrame([(5, 0, "x")], SCHEMA)
    load_partitions(spark, path, older, "k", "part", newest_by="v")
    assert (5, 1, "z") in stored(spark, path) and len(stored(spark, path)) == 5


def test_a_load_that_fails_halfway_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, 1, "z")], SCHEMA).write.partitionBy("part").parquet(path)
    batch = spark.createDataFrame([(1, 2, "x"), (2, 2, "x")], SCHEMA)

    def fails(spark, path, load, emptied, applied=False):
        note(spark, path, load, emptied, applied)
        raise RuntimeError("lost")

    note = incremental._note
    monkeypatch.setattr(incremental, "_note", fails)
    try:
        load_partitions(spark, path, batch, "k", "part")
    except RuntimeError:
        pass
    monkeypatch.undo()
    # The load is ready, and of what it replaces some is already gone.
    incremental._remove(spark, f"{path}/part=x")
    assert stored(spark, path) == [(2, 1, "y"), (3, 1, "z")]
    assert len(recover_partitions(spark, path, batch.schema, "part")) == 1
    assert stored(spark, path) == [(1, 2, "x"), (2, 2, "x"), (3, 1, "z")]
    assert recover_partitions(spark, path, batch.schema, "part") == []
