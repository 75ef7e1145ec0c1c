"""Silver to gold: dimensions with surrogate keys, and facts that point to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crispstar.operators.columns import by
from crispstar.operators.keys import surrogate_key

# The span of the date dimension and the status that earns revenue.
FIRST_DAY = dt.date(2013, 1, 1)
LAST_DAY = dt.date(2027, 12, 31)
EARNED = "success"

UNKNOWN_KEY = -1


def dim_customer(silver: DataFrame, unique_rows: bool = True) -> DataFrame:
    """Key and twelve attributes; address and device stay in silver.

    Silver has one row per customer; say so when the table given has not.
    """
    kept = silver.drop("address", "device_id_s")
    return surrogate_key(kept, ["customer_id"], "customer_key", unique_rows)


def dim_product(silver: DataFrame) -> DataFrame:
    """Key, id, name, category, price. Duplicate ids keep one key each."""
    kept = silver.select("product_id", "product_name", "category", "price")
    return surrogate_key(kept, ["product_id"], "product_key")


def dim_support_agent(silver: DataFrame, drop_empty: bool = False) -> DataFrame:
    agents = silver.filter(F.col("support_agent").isNotNull()).select("support_agent").distinct()
    if drop_empty:
        agents = agents.filter("support_agent <> ''")
    return surrogate_key(agents, ["support_agent"], "support_agent_key", unique_rows=True)


def _calendar(days: DataFrame) -> DataFrame:
    """Attributes of the days in column ``full_date``."""
    d = F.col("full_date")
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.when(F.weekday(d) >= 5, "Yes").otherwise("No").alias("is_weekend"),
    )


def dim_date_between(span: DataFrame, longest: int | None = None) -> DataFrame:
    """One row per day of a one-row span (``start_date``, ``end_date``), which is read at once.

    A span of more than ``longest`` days, such as a dirty year makes, is an error.
    """
    start, end = span.select("start_date", "end_date").first()
    if start is None or end is None:
        start, end = dt.date(1970, 1, 1), dt.date(1969, 12, 31)
    days = (end - start).days + 1
    if longest is not None and days > longest:
        raise ValueError(f"{days} days from {start} to {end}, more than {longest}")
    return dim_date(span.sparkSession, start, end)


def dim_date(spark: SparkSession, start: dt.date = FIRST_DAY, end: dt.date = LAST_DAY) -> DataFrame:
    """One row per day from start to end: a range, of which Catalyst knows the length."""
    days = spark.range(max(0, (end - start).days + 1))
    return _calendar(days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")))


def with_key(
    fact: DataFrame, dim: DataFrame, on: Column, key: str, name: str, match: str, unknown: bool = False
) -> DataFrame:
    """Add the dimension's ``key`` to the fact as ``name``; NULL (or -1) where nothing matches.

    Only the matching column and the key of the dimension take part. There is no
    broadcast hint: a dimension is a scan of a written table or a calendar of
    known length, so Catalyst knows its size, broadcasts it below the threshold
    and otherwise plans a sort-merge join between two plain exchanges, which AQE
    splits on skew. The temporary names keep a dimension usable twice.
    """
    lookup = dim.select(F.col(match).alias("_match"), F.col(key).alias("_key"))
    found = fact.join(lookup, on == F.col("_match"), "left")
    value = F.coalesce("_key", F.lit(UNKNOWN_KEY)) if unknown else F.col("_key")
    return found.withColumn(name, value).drop("_match", "_key")


def with_date_key(
    fact: DataFrame, dates: DataFrame, day: Column, name: str = "date_key", unknown: bool = False
) -> DataFrame:
    """``with_key`` for the date dimension; days outside of it find no key."""
    return with_key(fact, dates, day, "date_key", name, "full_date", unknown)


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    version: int = 2,
    unknown: bool = False,
    unique_products: bool = False,
) -> DataFrame:
    """Orders with customer, product and date keys. Version 1 has no status.

    A product id that occurs twice in the dimension doubles its orders, unless
    ``unique_products`` looks up the smallest key of each id: then every order is one row.
    """
    if unique_products:
        products = products.groupBy("product_id").agg(F.min("product_key").alias("product_key"))
    keyed = with_key(orders, customers, F.col("customer_id"), "customer_key", "customer_key", "customer_id", unknown)
    keyed = with_key(keyed, products, F.col("product_id"), "product_key", "product_key", "product_id", unknown)
    keyed = with_date_key(keyed, dates, F.col("order_date").cast("date"), unknown=unknown)
    measures = ["quantity", "order_amount", "payment_method", *(["status"] if version == 2 else [])]
    return keyed.select("order_id", "customer_key", "product_key", "date_key", *measures)


def with_month(fact: DataFrame, date_key: str = "date_key") -> DataFrame:
    """The fact with year and month of a date key, such as 202403, to be partitioned by. No key, no month."""
    return fact.withColumn("date_month", F.floor(F.col(date_key) / 100).cast("int"))


def in_years(fact: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of these years; a table partitioned by ``date_month`` reads no other."""
    return fact.filter(F.col("date_month").between(first * 100 + 1, last * 100 + 12))


def fact_support_tickets(
    tickets: DataFrame,
    customers: DataFrame,
    agents: DataFrame,
    dates: DataFrame,
    version: int = 2,
    unknown: bool = False,
) -> DataFrame:
    """Tickets with customer, agent and two date keys.

    Version 1 compares the timestamp itself with the day, so only midnight
    matches; version 2 compares its date.
    """

    def day(name: str) -> Column:
        c = F.col(name)
        return c.cast("date") if version == 2 else F.when(c == c.cast("date").cast("timestamp_ntz"), c.cast("date"))

    keyed = with_key(tickets, customers, F.col("customer_id"), "customer_key", "customer_key", "customer_id", unknown)
    keyed = with_key(
        keyed, agents, F.col("support_agent"), "support_agent_key", "support_agent_key", "support_agent", unknown
    )
    keyed = with_date_key(keyed, dates, day("ticket_created"), "created_date_key", unknown)
    keyed = with_date_key(keyed, dates, day("ticket_resolved"), "resolved_date_key", unknown)
    return keyed.select(
        "ticket_id",
        "customer_key",
        "created_date_key",
        "resolved_date_key",
        "support_agent_key",
        "issue_type",
        "sentiment",
        "resolution_time_hours",
    )


def fact_clickstream(
    events: DataFrame, customers: DataFrame, dates: DataFrame, unknown: bool = False
) -> DataFrame:
    keyed = with_key(events, customers, F.col("customer_id"), "customer_key", "customer_key", "customer_id", unknown)
    keyed = with_date_key(keyed, dates, F.col("timestamp").cast("date"), unknown=unknown)
    return keyed.select("event_id", "customer_key", "date_key", "event_type")


def earned(fact: DataFrame) -> DataFrame:
    """The orders that earned their amount."""
    return fact.filter(F.col("status") == EARNED)


def revenue_total(fact: DataFrame) -> DataFrame:
    return earned(fact).agg(F.sum("order_amount").alias("revenue"))


def revenue_stats(fact: DataFrame) -> DataFrame:
    return earned(fact).agg(
        F.min("order_amount").alias("min_amount"),
        F.max("order_amount").alias("max_amount"),
        F.avg("order_amount").alias("avg_amount"),
    )


def top_orders(fact: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` largest earned orders; the other columns settle equal amounts."""
    rows = earned(fact).select("order_id", "product_key", "quantity", "order_amount")
    ties = [by(c) for c in ("order_id", "product_key", "quantity")]
    return rows.orderBy(F.col("order_amount").desc(), *ties).limit(n)
