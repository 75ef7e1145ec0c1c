"""The layers over one data folder, built on demand for the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from crispstar.plans import gold, silver
from crispstar.session import prepare
from registry.bronze import bronze


class Layers:
    """Silver tables are plans; a dimension is built once, when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def bronze(self, name: str) -> DataFrame:
        return bronze(self.spark, self.sf_dir, f"bronze_{name}")

    def silver(self, name: str) -> DataFrame:
        return {
            "customers": silver.silver_customers,
            "orders": silver.silver_orders,
            "products": silver.silver_products,
            "tickets": silver.silver_tickets,
            "clickstream": silver.silver_clickstream,
        }[name](self.bronze(name))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(silver.with_clean_phones(self.silver("customers")))

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver("products"))

    @cached_property
    def dim_support_agent(self) -> DataFrame:
        return gold.dim_support_agent(self.silver("tickets"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark)

    def fact_orders(self, version: int = 2, unknown: bool = False, unique_products: bool = False) -> DataFrame:
        return gold.fact_orders(
            self.silver("orders"), self.dim_customer, self.dim_product, self.dim_date, version, unknown, unique_products
        )

    def orders_once(self) -> DataFrame:
        """The fact as the measures see it: one row per order."""
        return self.fact_orders(unique_products=True)

    def fact_support_tickets(self, version: int = 2) -> DataFrame:
        return gold.fact_support_tickets(
            self.silver("tickets"), self.dim_customer, self.dim_support_agent, self.dim_date, version
        )

    def fact_clickstream(self) -> DataFrame:
        return gold.fact_clickstream(self.silver("clickstream"), self.dim_customer, self.dim_date)
