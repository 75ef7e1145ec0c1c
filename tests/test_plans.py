"""The plans that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from crispstar.operators import completeness, uniqueness, values
from crispstar.plans import gold
from crispstar.session import materialize
from registry.queries import QUERIES
from registry.tables import Layers
from tests.conftest import SMALL, final_plan, plan

# A single task may hold: one-row aggregates, the top rows of a bounded report,
# months of a running total.
SINGLE_TASK = {
    "row_count", "key_null_count", "null_profile", "empty_profile", "blank_profile", "blank_profile_typed",
    "null_rate", "valid_counts", "null_combination", "null_combination_parsed",
    "null_share_by_group", "duplicate_key_count",
    "duplicate_key_pct", "unique_records_violations", "total_vs_distinct", "distinct_count", "surrogate_key_check",
    "non_numeric_rate", "negative_count", "negative_entity_pct", "duration_reconcile", "duration_reconcile_lenient",
    "duration_reconcile_multi", "fractional_values", "date_span_union", "revenue_total", "revenue_stats",
    "kpi_overview", "customer_growth", "avg_customer_spend", "avg_orders_per_customer", "customer_quartile_segments",
    "resolution_rate", "resolution_rate_stated", "customer_sentiment", "quality_rules", "orders_not_in_counts",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "stream_clickstream"])
def test_no_python_no_funnel_no_cross_join(registered, name):
    text = plan(registered(name))
    assert not re.search(r"Python|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", text)
    funnels = text.split("Exchange SinglePartition")[1:]
    assert bool(funnels) == (name in SINGLE_TASK)
    # Every single-task exchange carries partial aggregates, or months.
    for below in funnels:
        first = below.split("\n")[1]
        assert "partial_" in first or "merge_" in first or name == "customer_growth"


def test_filters_and_columns_reach_the_scan(spark):
    stored = materialize(Layers(spark, SMALL).fact_orders(), "fact")
    text = plan(gold.revenue_total(stored))
    assert "EqualTo(status,success)" in text
    assert "ReadSchema: struct<order_amount:decimal(10,2),status:string>" in text
    events = materialize(Layers(spark, SMALL).bronze("clickstream"), "events")
    assert "IsNull(timestamp)" in plan(completeness.null_rows(events, "timestamp"))
    assert "ReadSchema: struct<event_id:string>" in plan(uniqueness.duplicate_key_count(events, "event_id"))


def test_silver_projections_do_not_shuffle(spark):
    layers = Layers(spark, SMALL)
    for name in ("orders", "products", "tickets", "clickstream"):
        text = plan(layers.silver(name))
        assert "Exchange" not in text and "*(1)" in text
    assert plan(layers.silver("customers")).count("Exchange") == 1


def test_profiles_read_the_table_once(spark):
    events = materialize(Layers(spark, SMALL).bronze("clickstream"), "events")
    for df in (
        completeness.null_profile(events, mode="blank"),
        uniqueness.duplicate_key_pct(events, "customer_id"),
        values.negative_entity_pct(events, "event_id", "customer_id"),
        uniqueness.total_vs_distinct(events, "customer_id"),
    ):
        assert plan(df).count("FileScan") == 1


def test_shares_reuse_the_exchange_of_their_counts(spark):
    events = materialize(Layers(spark, SMALL).bronze("clickstream"), "events")
    assert "ReusedExchange" in final_plan(completeness.null_share_by_group(events, "page_url", "event_type"))


def test_facts_broadcast_small_dims_without_moving_the_fact(spark):
    text = plan(Layers(spark, SMALL).fact_orders())
    # Three lookups, and the key offsets of two of the dimensions.
    assert text.count("BroadcastHashJoin") == 5
    assert "hashpartitioning" not in text


def test_dims_join_by_their_two_columns(spark):
    text = plan(Layers(spark, SMALL).fact_clickstream())
    assert "ReadSchema: struct<customer_id:string,_stamp:bigint>" in text


def test_top_reports_do_not_sort_the_table(spark):
    layers = Layers(spark, SMALL)
    stored = materialize(layers.fact_orders(), "fact")
    assert "TakeOrderedAndProject" in plan(gold.top_orders(stored))
    assert "TakeOrderedAndProject" in plan(values.top_values(layers.bronze("orders"), "order_amount"))
    assert "TakeOrderedAndProject" in plan(values.random_group(layers.bronze("orders"), "product_id"))


def test_result_does_not_depend_on_partitions(spark, settings):
    layers = Layers(spark, SMALL)
    bronze = layers.bronze("customers")
    first = sorted(map(str, gold.dim_customer(uniqueness.dedup_by_key(bronze, "customer_id")).collect()))
    settings(spark__sql__shuffle__partitions="3")
    shuffled = bronze.repartition(7, F.col("address"))
    again = sorted(map(str, gold.dim_customer(uniqueness.dedup_by_key(shuffled, "customer_id")).collect()))
    assert first == again
