"""Operators on small literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crispstar.operators import completeness, rules, uniqueness, values
from crispstar.operators.incremental import incremental_load
from crispstar.operators.intervals import impute_interval, valid_intervals
from crispstar.plans import gold, kpi
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    data = [("a", 1, None), ("a", 2, "x"), ("b", 3, ""), (None, 4, " "), (None, 5, "y"), ("c", None, "y")]
    return spark.createDataFrame(data, "k string, n int, t string")


def test_missing_values(people):
    assert rows(completeness.null_profile(people)) == [(2, 1, 1)]
    assert rows(completeness.null_profile(people, mode="empty")) == [(2, 1, 2)]
    assert rows(completeness.null_profile(people, ["t"], mode="blank")) == [(3,)]
    with pytest.raises(ValueError):
        completeness.null_profile(people, mode="odd")
    assert rows(completeness.null_combination(people, "k", "n")) == [(0, 2, 1)]
    assert rows(completeness.null_share_by_group(people, "k", "t")) == [(" ", 1, 50.0), ("y", 1, 50.0)]
    assert rows(completeness.valid_counts(people, ["n"])) == [(6, 5, 1)]


def test_rates_round_half_up_and_survive_empty_tables(spark, people):
    assert rows(completeness.null_rate(spark.range(20000).select(F.when(F.col("id") >= 201, 1).alias("x")), "x")) == [
        (20000, 201, 1.01)  # 1.005 %
    ]
    nothing = people.filter("n > 100")
    assert rows(completeness.null_rate(nothing, "n")) == [(0, 0, None)]
    assert rows(uniqueness.duplicate_key_pct(nothing, "k")) == [(0, 0, None)]
    assert rows(completeness.null_share_by_group(nothing, "k", "t")) == []


def test_keys(people):
    assert rows(uniqueness.duplicate_keys(people, "k")) == [(None, 2), ("a", 2)]
    assert rows(uniqueness.duplicate_key_count(people, "k")) == [(2,)]
    assert rows(uniqueness.duplicate_key_pct(people, "k")) == [(2, 6, 33.33)]
    assert [r[1] for r in rows(uniqueness.duplicate_records(people, "k"))] == [1, 2]
    assert sorted(r[1] or 0 for r in uniqueness.unique_records(people, "k").collect()) == [0, 3, 4, 5]
    assert rows(uniqueness.total_vs_distinct(people, "k")) == [(6, 3)]
    assert rows(uniqueness.total_vs_distinct(people, "k", approximate=True)) == [(6, 3)]
    assert rows(uniqueness.distinct_count(people, "k")) == [(4,)]
    assert rows(uniqueness.duplicate_null_histogram(people, "k", "t")) == [(1, 1)]


def test_dedup_order(people):
    kept = uniqueness.dedup_by_key(people, "k", [F.col("n").desc()])
    assert rows(kept) == [(None, 5, "y"), ("a", 2, "x"), ("b", 3, ""), ("c", None, "y")]
    assert rows(uniqueness.dedup_by_key(kept, "k")) == rows(kept)


def test_signs(spark):
    data = [("p", "1"), ("p", "-1"), ("p", "x"), ("q", "0"), ("q", None), ("r", "-5"), ("r", "-5"), ("s", "1,5")]
    df = spark.createDataFrame(data, "product_id string, order_amount string")
    assert rows(values.sign_flags(df, "order_amount", "product_id")) == [
        ("p", 1, 1), ("q", 0, 0), ("r", 1, 0), ("s", 0, 0)
    ]
    assert rows(values.signed_counts(df, "order_amount", "product_id")) == [
        ("p", 1, 2), ("q", 0, 2), ("r", 2, 0), ("s", 0, 1)
    ]
    assert rows(values.offset_pairs(df)) == [("p", 1.0, 1, 1)]
    assert rows(values.repeated_abs_amounts(df)) == [("p", 1.0, 2), ("r", 5.0, 2)]
    assert rows(values.negative_entity_pct(df, "order_amount", "product_id")) == [(2, 4, 50.0)]
    assert rows(values.sentinel_rows(df, "order_amount", 15)) == [("s", "1,5")]


def test_offset_pairs_either_way(spark):
    df = spark.createDataFrame([("p", a) for a in ("1", "-1", "2", "-2")], "product_id string, order_amount string")
    assert [r[1] for r in values.offset_pairs(df).collect()] == [1.0, 2.0]
    assert [r[1] for r in values.offset_pairs(df, largest_first=True).collect()] == [2.0, 1.0]


def test_sample_and_random_group_repeat(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    one = rows(values.sample_rows(df, 1, 10**6, "id", seed=1))
    assert one == rows(values.sample_rows(df.repartition(7), 1, 10**6, "id", seed=1))
    assert 120 < len(one) < 280 and one != rows(values.sample_rows(df, 1, 10**6, "id", seed=2))
    assert len(rows(values.sample_rows(df, 50, 30, "id"))) == 30
    assert values.sample_rows(df, 100, 10**6, "id").count() == 20000
    picks = {values.random_group(df.limit(50), "id", seed=s).first()[0] for s in range(5)}
    assert len(picks) > 1


def test_future_dates_default_to_today(spark):
    today = dt.date.today()
    days = [(today - dt.timedelta(2),), (today + dt.timedelta(2),), (None,)]
    df = spark.createDataFrame(days, "d date")
    assert rows(rules.future_dates(df, ["d"])) == [days[1]]


def test_intervals(spark):
    t = dt.datetime(2024, 1, 1, 12)
    h = dt.timedelta(hours=1)
    data = [(1, t, None, 2.9), (2, None, t, 2.9), (3, None, None, 1.0), (4, t, None, -2.5), (5, t, t - h, 1.0),
            (6, t, None, None)]
    df = spark.createDataFrame(data, "i int, a timestamp_ntz, b timestamp_ntz, h double")
    filled = {r["i"]: (r["a"], r["b"]) for r in impute_interval(df, "a", "b", "h").collect()}
    assert filled == {1: (t, t + 2 * h), 2: (t - 2 * h, t), 3: (None, None), 4: (t, t - 2 * h), 5: (t, t - h),
                      6: (t, None)}
    assert [r["i"] for r in rows_of(valid_intervals(df, "a", "b"))] == [1, 2, 4, 6]


def rows_of(df):
    return sorted(df.collect(), key=lambda r: r["i"])


def test_quality(spark, people):
    checks = {"has_key": F.col("k").isNotNull(), "small": F.col("n") < 4}
    assert rows(rules.quality_rules(people, checks)) == [("has_key", 6, 2, 33.33), ("small", 6, 3, 50.0)]
    failed = {(r["n"], tuple(r["failed_rules"])) for r in rules.quarantine(people, checks).collect()}
    assert failed == {(4, ("has_key", "small")), (5, ("has_key", "small")), (None, ("small",))}


def test_upsert(spark, people):
    batch = spark.createDataFrame([("a", 9, "new"), ("a", 8, "new"), ("z", 1, "new"), (None, 0, "new")], people.schema)
    got = rows(incremental_load(people, batch, "k"))
    assert got == [(None, 0, "new"), ("a", 8, "new"), ("b", 3, ""), ("c", None, "y"), ("z", 1, "new")]


# --- star schema --------------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    day = dt.date(2024, 3, 4)
    orders = spark.createDataFrame(
        [("o1", "c1", "p1", 1, 10, day, "success", "card"), ("o2", "c1", "p2", 2, 20, dt.date(1999, 1, 1), "success", None),
         ("o3", None, "p9", 3, 30, None, "failed", "upi"), ("o4", "c9", "p1", 1, 5, day, "success", "upi")],
        "order_id string, customer_id string, product_id string, quantity int, order_amount int, order_date date,"
        " status string, payment_method string",
    ).withColumn("order_amount", F.col("order_amount").cast("decimal(10,2)"))
    customers = spark.createDataFrame([("c1",), ("c2",), (None,)], "customer_id string").select(
        "customer_id", *[F.lit(None).cast("string").alias(c) for c in ("first_name", "address", "device_id_s")]
    )
    products = spark.createDataFrame(
        [("p1", "A", "toys", 1), ("p1", "B", "home", 2), ("p2", "C", None, 3)],
        "product_id string, product_name string, category string, price int",
    )
    return orders, gold.dim_customer(customers), products, gold.dim_date(spark)


def test_duplicate_products_fan_out_unless_deduplicated(star):
    orders, customers, products, dates = star
    faithful = gold.fact_orders(orders, customers, gold.dim_product(products), dates)
    assert faithful.count() == 6
    single = gold.dim_product(uniqueness.dedup_by_key(products, "product_id"))
    fact = gold.fact_orders(orders, customers, single, dates)
    assert [(r[0], r[1], r[2], r[3]) for r in rows(fact)] == [
        ("o1", 2, 1, 20240304), ("o2", 2, 2, None), ("o3", None, None, None), ("o4", None, 1, 20240304)
    ]
    once = gold.fact_orders(orders, customers, gold.dim_product(products), dates, unique_products=True)
    assert sorted(r[0] for r in rows(once)) == ["o1", "o2", "o3", "o4"]
    assert kpi.kpi_overview(once, customers, orders).first()["orders"] == orders.count()
    unknown = gold.fact_orders(orders, customers, single, dates, unknown=True)
    assert rows(unknown)[2][1:4] == (-1, -1, -1)
    assert "status" not in gold.fact_orders(orders, customers, single, dates, version=1).columns


def test_measures(star):
    orders, customers, products, dates = star
    dim = gold.dim_product(uniqueness.dedup_by_key(products, "product_id"))
    fact = gold.fact_orders(orders, customers, dim, dates)
    assert float(gold.revenue_total(fact).first()[0]) == 35.0
    assert [r["order_id"] for r in gold.top_orders(fact, 2).collect()] == ["o2", "o1"]
    assert [tuple(map(str, r)) for r in kpi.revenue_trend(fact, dates).collect()] == [
        ("None", "None", "20.00"), ("2024", "3", "15.00")
    ]
    assert rows(kpi.order_trend(fact, dates)) == [(None, None, 2), (2024, 3, 2)]
    assert tuple(map(float, kpi.avg_customer_spend(fact).first())) == (30.0, 1.0, 30.0)
    assert rows(kpi.avg_orders_per_customer(fact)) == [(2, 1, 2.0)]
    assert rows(kpi.revenue_distribution(fact, 20)) == [(20, 1)]
    segment = kpi.customer_segmentation(fact, 10, 25).first()
    assert (segment["segment"], segment["customers"]) == ("High", 1)
    overview = kpi.kpi_overview(fact, customers, orders).first()
    assert tuple(map(float, overview)) == (35.0, 4.0, 3.0, 4.0, 4.0)


def test_date_dimension(spark):
    dates = gold.dim_date(spark)
    assert dates.count() == 5478
    days = {r["full_date"]: r for r in dates.collect()}
    sunday = days[dt.date(2023, 1, 1)]
    assert tuple(sunday) == (20230101, dt.date(2023, 1, 1), 2023, 1, 1, "January", 1, "Sunday", 52, "Yes")
    assert days[dt.date(2023, 1, 7)]["is_weekend"] == "Yes" and days[dt.date(2023, 1, 6)]["is_weekend"] == "No"


def test_agents_without_letters(spark):
    tickets = spark.createDataFrame([("",), ("Ann",), ("Ann",), (None,)], "support_agent string")
    assert rows(gold.dim_support_agent(tickets)) == [(1, ""), (2, "Ann")]
    assert rows(gold.dim_support_agent(tickets, drop_empty=True)) == [(1, "Ann")]


def test_surrogate_keys_are_dense(star):
    low, high, distinct, total = uniqueness.surrogate_key_check(star[1], "customer_key").first()
    assert (low, high, distinct, total) == (1, 3, 3, 3)
