"""The whole build, published and published again."""

import importlib

from crispstar.plans.build import build_warehouse
from crispstar.sources import tables
from crispstar.sources.schemas import CLICKSTREAM, CUSTOMERS, ORDERS, PRODUCTS, TICKETS
from registry.tables import Layers
from tests.conftest import SMALL, rows


def test_bronze_columns_are_the_declared_ones(spark):
    layers = Layers(spark, SMALL)
    for name, schema in [
        ("customers", CUSTOMERS), ("orders", ORDERS), ("products", PRODUCTS), ("tickets", TICKETS),
        ("clickstream", CLICKSTREAM),
    ]:
        got = [(f.name, f.dataType) for f in layers.bronze(name).schema]
        assert got == [(f.name, f.dataType) for f in schema]


def test_build_and_rebuild(spark, tmp_path):
    layers = Layers(spark, SMALL)
    bronze = {n: layers.bronze(n) for n in ("customers", "orders", "products", "tickets", "clickstream")}
    root = str(tmp_path)
    built = build_warehouse(spark, bronze, root)
    assert sorted(built) == sorted(
        "customers orders products support_tickets clickstream dim_customer dim_product dim_support_agent dim_date"
        " fact_orders fact_support_tickets fact_clickstream".split()
    )
    assert rows(built["fact_support_tickets"]) == rows(layers.fact_support_tickets())
    assert built["fact_clickstream"].count() == bronze["clickstream"].count()
    first = {name: rows(df) for name, df in built.items()}
    again = build_warehouse(spark, bronze, root)
    assert {name: rows(df) for name, df in again.items()} == first
    assert tables.current_version(spark, f"{root}/gold/fact_orders") == 1
    # Readers of the first version still see it.
    assert rows(tables.read_version(spark, f"{root}/gold/fact_orders", 0)) == first["fact_orders"]


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    flagship = entry.entry(spark)
    assert flagship.columns == ["category", "revenue"] and flagship.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
