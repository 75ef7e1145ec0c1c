"""Multisets, lists with NULLs, sketches, subtotals and bucketed tables against plain Python."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crispstar.operators import aggregates, sets
from crispstar.session import scratch_path
from crispstar.sources.buckets import publish_bucketed
from tests.conftest import final_plan, rows


def draw(rng, n):
    return [(None if rng.random() < 0.2 else str(rng.integers(0, 4)), None if rng.random() < 0.2 else int(rng.integers(0, 3))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_multiset_difference(spark, seed):
    rng = np.random.default_rng(seed)
    before, after = draw(rng, 60), draw(rng, 50)
    old, new = (spark.createDataFrame(x, "k string, v int").repartition(3) for x in (before, after))
    one, two = Counter(before), Counter(after)
    want = Counter({(*r, "removed", n): 1 for r, n in (one - two).items()}) + Counter({(*r, "added", n): 1 for r, n in (two - one).items()})
    assert Counter(map(tuple, sets.multiset_difference(old, new).collect())) == want
    sides = {}
    for k, _, change, _ in want:
        sides.setdefault(k, set()).add(change)
    named = {"added": "changed to", "removed": "changed from"}
    changed = Counter((k, v, named[c] if len(sides[k]) == 2 else c, n) for k, v, c, n in want)
    assert Counter(map(tuple, sets.table_changes(old, new, "k").collect())) == changed
    assert sets.multiset_difference(old, old).count() == 0


def test_difference_counts_copies_before_the_shuffle(spark):
    copies = spark.range(6000, numPartitions=4).select(F.lit("same").alias("k"))
    made = sets.multiset_difference(copies, copies.limit(10))
    assert rows(made) == [("same", "removed", 5990)] and "partial_sum" in final_plan(made)


def test_not_in_and_not_exists(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    for listed, inside, exists in ((["a"], ["b"], [None, "b"]), (["a", None], [], [None, "b"]), ([], [None, "a", "b"], [None, "a", "b"]), ([None], [], [None, "a", "b"])):
        held = spark.createDataFrame([(x,) for x in listed], "x string")
        assert [r[0] for r in rows(sets.not_in(left, "k", held, "x"))] == inside
        assert [r[0] for r in rows(sets.not_exists(left, "k", held, "x"))] == exists
        left.createOrReplaceTempView("l")
        held.createOrReplaceTempView("r")
        assert [r[0] for r in rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT x FROM r)"))] == inside


def test_not_in_is_a_plain_join_of_any_size(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    left = spark.range(100).select(F.col("id").cast("string").alias("k"))
    text = final_plan(sets.not_in(left, "k", left.filter("id % 3 = 0"), "k"))
    assert "SortMergeJoin" in text and "NestedLoop" not in text


def test_sketches_of_days_merge_to_what_one_pass_gives(spark):
    seen = spark.range(200_000, numPartitions=6).select((F.col("id") % 30).alias("day"), F.xxhash64(F.col("id") % 60_000).alias("user"))
    daily = aggregates.distinct_sketches(seen, ["day"], "user")
    merged = aggregates.merged_distinct(daily, [], "n").first()[0]
    once = aggregates.merged_distinct(seen.agg(F.hll_sketch_agg("user", aggregates.PRECISION).alias("sketch")), [], "n").first()[0]
    assert merged == once and abs(merged - 60_000) < 0.03 * 60_000
    none = aggregates.distinct_sketches(seen.limit(0), ["day"], "user")
    assert aggregates.merged_distinct(none, ["day"], "n").count() == 0


def test_quantiles_of_merged_sketches_have_nearly_their_rank(spark):
    values = spark.range(100_000, numPartitions=5).select((F.col("id") % 3).alias("g"), (F.col("id") % 20).alias("day"), (F.hash("id") % 1000).cast("double").alias("v"))
    values = values.unionByName(spark.sql("SELECT 0L AS g, 0L AS day, CAST(NULL AS DOUBLE) AS v"))
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    found = {r["g"]: r for r in aggregates.merged_quantiles(aggregates.quantile_sketches(values, ["g", "day"], "v"), ["g"], shares).collect()}
    exact = {r["g"]: r for r in aggregates.grouped_percentiles(values, ["g"], "v", shares).collect()}
    held = {g: sorted(r["v"] for r in values.filter(f"g = {g} AND v IS NOT NULL").collect()) for g in range(3)}
    for g, all_values in held.items():
        for name, p in shares.items():
            assert abs(np.searchsorted(all_values, found[g][name]) / len(all_values) - p) < 0.02
            assert exact[g][name] == pytest.approx(np.percentile(all_values, 100 * p))


def test_subtotals_tell_null_groups_from_totals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 4)], "p string, q string, v int")
    got = rows(aggregates.subtotals(df, ["p", "q"], F.sum("v").alias("v")))
    want = [("a", "x", "p,q", 1), ("a", None, "p,q", 2), (None, "x", "p,q", 4), ("a", None, "p", 3), (None, None, "p", 4), (None, "x", "q", 5), (None, None, "q", 2), (None, None, "", 7)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pivot_has_the_declared_columns(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "z", 2), ("b", None, 4)], "p string, q string, v int")
    got = aggregates.pivoted(df, ["p"], "q", ["x", "y"], F.sum("v"))
    assert got.columns == ["p", "x", "y"] and rows(got) == [("a", 1, None), ("b", None, None)]


def test_bucketed_tables_meet_without_a_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    facts = spark.range(5000, numPartitions=4).select((F.col("id") % 300).alias("key"), F.col("id").alias("v"))
    names = spark.range(300).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    one = publish_bucketed(facts, "bucketed_facts", "key", 8, scratch_path(spark, "facts"))
    two = publish_bucketed(names, "bucketed_names", "key", 8, scratch_path(spark, "names"))
    joined = one.join(two, "key").groupBy("key", "name").agg(F.sum("v").alias("v"))
    text = final_plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert rows(joined) == rows(facts.join(names, "key").groupBy("key", "name").agg(F.sum("v").alias("v")))
    for name in ("facts", "names"):
        spark.sql(f"DROP TABLE bucketed_{name}")
