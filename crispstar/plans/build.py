"""The whole build, in the one order that works: silver, dimensions, facts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from crispstar.plans import gold, silver
from crispstar.sources.tables import publish

Plans = dict[str, Callable[[], DataFrame]]


def silver_plans(bronze: dict[str, DataFrame]) -> Plans:
    return {
        "customers": lambda: silver.with_clean_phones(silver.silver_customers(bronze["customers"])),
        "orders": partial(silver.silver_orders, bronze["orders"]),
        "products": partial(silver.silver_products, bronze["products"]),
        "support_tickets": partial(silver.silver_tickets, bronze["tickets"]),
        "clickstream": partial(silver.silver_clickstream, bronze["clickstream"]),
    }


def dim_plans(spark: SparkSession, cleaned: dict[str, DataFrame]) -> Plans:
    return {
        "dim_customer": partial(gold.dim_customer, cleaned["customers"]),
        "dim_product": partial(gold.dim_product, cleaned["products"]),
        "dim_support_agent": partial(gold.dim_support_agent, cleaned["support_tickets"]),
        "dim_date": partial(gold.dim_date, spark),
    }


def fact_plans(cleaned: dict[str, DataFrame], dims: dict[str, DataFrame]) -> Plans:
    customers, dates = dims["dim_customer"], dims["dim_date"]
    return {
        "fact_orders": partial(gold.fact_orders, cleaned["orders"], customers, dims["dim_product"], dates),
        "fact_support_tickets": partial(
            gold.fact_support_tickets, cleaned["support_tickets"], customers, dims["dim_support_agent"], dates
        ),
        "fact_clickstream": partial(gold.fact_clickstream, cleaned["clickstream"], customers, dates),
    }


def publish_all(
    spark: SparkSession, folder: str, plans: Plans, partition_by: str | None = None
) -> dict[str, DataFrame]:
    """Publish the tables of one layer side by side, so that small ones do not leave executors idle."""

    def make(name: str) -> DataFrame:
        return publish(plans[name](), f"{folder}/{name}", partition_by=partition_by)

    with ThreadPoolExecutor(len(plans)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(partial(make, name))) for name in plans}
        return {name: task.result() for name, task in running.items()}


def monthly(plans: Plans) -> Plans:
    """The facts with the month of their (first) date key."""
    dated = {"fact_support_tickets": "created_date_key"}
    return {name: lambda n=name, p=plan: gold.with_month(p(), dated.get(n, "date_key")) for name, plan in plans.items()}


def build_warehouse(
    spark: SparkSession, bronze: dict[str, DataFrame], root: str, by_month: bool = False
) -> dict[str, DataFrame]:
    """Clean, key and publish every table below ``root``; returns scans of the published tables.

    Each layer reads the published tables of the layer before, so nothing is
    computed twice and joins see real sizes. With ``by_month`` the facts have a
    column ``date_month`` and a folder for each of its values.
    """
    cleaned = publish_all(spark, f"{root}/silver", silver_plans(bronze))
    dims = publish_all(spark, f"{root}/gold", dim_plans(spark, cleaned))
    plans = fact_plans(cleaned, dims)
    if by_month:
        facts = publish_all(spark, f"{root}/gold", monthly(plans), "date_month")
    else:
        facts = publish_all(spark, f"{root}/gold", plans)
    return {**cleaned, **dims, **facts}
