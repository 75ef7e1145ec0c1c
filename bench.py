"""Time headline queries over $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from crispstar.plans.build import build_warehouse
from crispstar.session import materialize, prepare, scratch_path
from registry.queries import QUERIES
from registry.tables import Layers

BRONZE = ("customers", "orders", "products", "tickets", "clickstream", "mixed_tickets")

HEADLINE = [
    "null_profile",
    "blank_profile",
    "duplicate_key_pct",
    "duplicate_records",
    "unique_records",
    "total_vs_distinct",
    "negative_entity_pct",
    "offset_pairs",
    "expected_amount",
    "duration_reconcile",
    "date_span_union",
    "silver_customers",
    "silver_orders",
    "silver_products",
    "silver_tickets",
    "silver_clickstream",
    "dim_customer",
    "dim_product",
    "fact_orders",
    "fact_support_tickets",
    "fact_clickstream",
    "revenue_total",
    "top_orders",
    "kpi_overview",
    "revenue_by_category",
    "customer_segmentation",
    "customer_quartile_segments",
    "valid_ticket_filter",
    "incremental_load",
    "stream_clickstream",
    "csv_scan_by_name",
    "load_partitions",
    "stream_window_counts",
    "as_of_ticket",
    "events_during_tickets",
    "customer_sessions",
    "status_history",
    "stream_sessions",
    "stream_tickets_after_clicks",
    "customers_per_month_sketched",
    "resolution_percentiles",
    "revenue_cube",
    "customer_changes",
    "spend_of_bucketed_tables",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Bronze is stored before the clock starts, as it is in use; the queries are what is timed.
    stored = {n: materialize(Layers(spark, folder).bronze(n), f"bronze-{n}") for n in BRONZE}

    class Stored(Layers):
        def bronze(self, name: str) -> DataFrame:
            return stored[name]

    run(QUERIES["row_count"](Stored(spark, folder)))  # start the executors

    seconds = {}
    for name in HEADLINE:
        begun = time.perf_counter()
        run(QUERIES[name](Stored(spark, folder)))
        seconds[name] = round(time.perf_counter() - begun, 3)

    bronze = {n: stored[n] for n in BRONZE if n != "mixed_tickets"}
    begun = time.perf_counter()
    build_warehouse(spark, bronze, scratch_path(spark, "warehouse"))
    seconds["build_warehouse"] = round(time.perf_counter() - begun, 3)

    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder}))
    spark.stop()


if __name__ == "__main__":
    main()
