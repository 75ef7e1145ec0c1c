"""Hot keys: one key, or one group of copies, holds a large part of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from crispstar.operators import uniqueness, values
from crispstar.operators.keys import surrogate_key
from crispstar.plans import gold
from crispstar.session import materialize
from tests.conftest import final_plan, plan, rows

TINY_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2000",
}


@pytest.fixture(scope="module")
def hot(spark):
    """9,000 rows in twelve files: a third has no key, a third one key, a tenth of the rows are copies."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))
    )
    payload = F.when(F.col("id") % 10 == 4, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(9000, numPartitions=12).select(key.alias("key"), payload.alias("payload"))
    return materialize(df, "hot")


def test_dedup_keeps_one_row_per_task_before_the_shuffle(hot):
    deduped = uniqueness.dedup_by_key(hot, "key")
    text = plan(deduped)
    assert "WindowGroupLimit [key" in text and "Partial" in text
    expected = {}
    for key, payload in rows(hot):
        expected[key] = min(payload, expected.get(key, payload))
    assert dict(rows(deduped)) == expected


def test_dedup_can_keep_rows_without_key(hot):
    kept = uniqueness.dedup_by_key(hot, "key", keep_null_keys=True)
    counts = Counter(r[0] for r in kept.collect())
    assert counts.pop(None) == hot.filter("key is null").count()
    assert set(counts.values()) == {1}


def test_duplicate_and_unique_records_cover_the_table(hot, settings):
    settings(**TINY_SKEW)
    counts = Counter(r[0] for r in rows(hot))
    dups, unique = uniqueness.duplicate_records(hot, "key"), uniqueness.unique_records(hot, "key")
    assert rows(dups) == [r for r in rows(hot) if r[0] is not None and counts[r[0]] > 1]
    assert rows(unique) == [r for r in rows(hot) if r[0] is None or counts[r[0]] == 1]
    assert "skew=true" in final_plan(unique)
    assert "skew=true" in final_plan(uniqueness.duplicate_records(hot, "key", ordered=False))


def test_sorting_duplicates_splits_copies(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    copies = materialize(spark.range(6000, numPartitions=6).select(F.lit("same").alias("key")), "copies")
    dups = uniqueness.duplicate_records(copies, "key")
    sizes = dups.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) < 3000


def test_star_join_splits_a_hot_key(spark, hot, settings):
    distinct = hot.filter("key is not null").select("key").distinct()
    dim = surrogate_key(distinct, ["key"], "dim_key", unique_rows=True)
    keys = dict((k, n) for n, k in rows(dim))
    small = gold.with_key(hot, dim, F.col("key"), "dim_key", "dim_key", "key")
    assert "BroadcastHashJoin" in plan(small)
    expected = sorted((k, p, keys.get(k)) for k, p in rows(hot) if k) + [
        (k, p, None) for k, p in rows(hot) if k is None
    ]
    assert Counter(map(tuple, small.collect())) == Counter(expected)
    settings(**TINY_SKEW)
    large = gold.with_key(hot, dim, F.col("key"), "dim_key", "dim_key", "key")
    assert "SortMergeJoin(skew=true)" in final_plan(large)
    assert Counter(map(tuple, large.collect())) == Counter(expected)


def test_surrogate_key_splits_hot_values_and_copies(spark, hot, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    copies = materialize(
        spark.range(6000, numPartitions=6).select(F.lit("same").alias("key"), F.lit(0).cast("bigint").alias("payload")),
        "copies",
    )
    keyed = surrogate_key(hot.unionByName(copies), ["key"], "n")
    listed = sorted(keyed.collect())
    assert [r["n"] for r in listed] == list(range(1, 15001))
    order = [(r["key"] is not None, r["key"] or "", r["payload"]) for r in listed]
    assert order == sorted(order)
    # Each file that is read back holds one range partition, and the copies lie in several of them.
    sizes = keyed.filter("key = 'same'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) < 3000


def test_surrogate_key_of_an_empty_table(hot):
    empty = surrogate_key(hot.filter("payload < -5"), ["key"], "n")
    assert empty.columns == ["n", "key", "payload"] and empty.count() == 0


def test_surrogate_key_does_not_depend_on_partitions(hot, settings):
    first = rows(surrogate_key(hot, ["key"], "n"))
    settings(spark__sql__shuffle__partitions="3")
    assert rows(surrogate_key(hot.repartition(5, "payload"), ["key"], "n")) == first


def test_sorts_have_a_key_to_cut_on(hot):
    ordered = [r["key"] for r in values.sorted_scan(hot, "key").collect()]
    assert ordered == sorted(ordered, key=lambda k: (k is not None, k or ""))
    assert "payload" in plan(values.sorted_scan(hot, "key")).split("rangepartitioning")[1]


def test_grouped_reports_aggregate_before_the_shuffle(hot):
    for report in (
        uniqueness.duplicate_keys(hot, "key"),
        uniqueness.duplicate_group_nulls(hot, "key", "payload"),
        values.sign_flags(hot, "payload", "key"),
        values.value_frequency(hot, "key"),
    ):
        text = plan(report)
        assert text.count("partial_") >= 1 and "collect_" not in text
