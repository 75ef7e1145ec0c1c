"""Business measures over the star schema.

All of them aggregate before they join: a fact is reduced to one row per key
with partial sums, and the small result meets the dimension. Rows whose key
found no dimension row are kept under NULL, unless a measure is about known
customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crispstar.operators.columns import by, percent, ratio
from crispstar.operators.keys import surrogate_key
from crispstar.plans.gold import EARNED, earned

# Sums of two-place amounts: room for 18 digits before the point.
REVENUE = "decimal(20,2)"


def mean(col: str) -> Column:
    """A mean that no order of summing changes: a decimal sum, divided once."""
    return F.try_divide(F.sum(F.col(col).cast("decimal(20,6)")).cast("double"), F.count(col))


def kpi_overview(orders: DataFrame, customers: DataFrame, events: DataFrame) -> DataFrame:
    """Revenue, orders, customers, products sold and website events on one row.

    Each number is a scalar subquery over one table.
    """
    won = F.col("status") == EARNED
    sales = orders.agg(
        F.sum(F.when(won, F.col("order_amount"))).alias("revenue"),
        F.count("*").alias("orders"),
        F.sum(F.when(won, F.col("quantity"))).alias("products_sold"),
    )
    return sales.select(
        "revenue",
        "orders",
        customers.agg(F.count("*")).scalar().alias("customers"),
        "products_sold",
        events.agg(F.count("*")).scalar().alias("website_events"),
    )


def _per_month(fact: DataFrame, dates: DataFrame, date_key: str, *measures: Column) -> DataFrame:
    """Aggregate per day first, so that the calendar meets one row per day."""
    days = dates.select(F.col("date_key").alias("_day"), "year", "month")
    return fact.groupBy(F.col(date_key).alias("_day")).agg(*measures).join(days, "_day", "left")


def revenue_trend(orders: DataFrame, dates: DataFrame) -> DataFrame:
    daily = _per_month(earned(orders), dates, "date_key", F.sum("order_amount").alias("amount"))
    monthly = daily.groupBy("year", "month").agg(F.sum("amount").cast(REVENUE).alias("revenue"))
    return monthly.orderBy(by("year"), by("month"))


def order_trend(orders: DataFrame, dates: DataFrame) -> DataFrame:
    daily = _per_month(orders, dates, "date_key", F.count("*").alias("n"))
    return daily.groupBy("year", "month").agg(F.sum("n").alias("orders")).orderBy(by("year"), by("month"))


def ticket_volume(tickets: DataFrame, dates: DataFrame) -> DataFrame:
    daily = _per_month(tickets, dates, "created_date_key", F.count("*").alias("n"))
    return daily.groupBy("year", "month").agg(F.sum("n").alias("tickets")).orderBy(by("year"), by("month"))


def revenue_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    per_product = earned(orders).groupBy("product_key").agg(F.sum("order_amount").alias("amount"))
    lookup = products.select("product_key", "category")
    joined = per_product.join(lookup, "product_key", "left")
    return joined.groupBy("category").agg(F.sum("amount").cast(REVENUE).alias("revenue")).orderBy(by("category"))


def customer_growth(customers: DataFrame) -> DataFrame:
    """New customers per signup month and their running total.

    The running total is taken over the months, not over the customers. A
    customer without a signup date has no month and is left out.
    """
    month = F.trunc("signup_date", "month").alias("signup_month")
    dated = customers.filter(F.col("signup_date").isNotNull())
    monthly = dated.groupBy(month).agg(F.count("*").alias("new_customers"))
    so_far = Window.orderBy("signup_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn("total_customers", F.sum("new_customers").over(so_far)).orderBy("signup_month")


def _spend(orders: DataFrame) -> DataFrame:
    """Revenue and orders of every known customer with an earned order."""
    known = earned(orders).filter(F.col("customer_key").isNotNull())
    return known.groupBy("customer_key").agg(
        F.coalesce(F.sum("order_amount"), F.lit(0)).cast(REVENUE).alias("spend")
    )


def avg_customer_spend(orders: DataFrame) -> DataFrame:
    """Revenue of the known customers, their number, and revenue per customer."""
    return _spend(orders).agg(
        F.sum("spend").cast(REVENUE).alias("revenue"),
        F.count("*").alias("customers"),
        ratio(F.sum("spend"), F.count("*")).alias("avg_spend"),
    )


def avg_orders_per_customer(orders: DataFrame) -> DataFrame:
    known = orders.filter(F.col("customer_key").isNotNull())
    per_customer = known.groupBy("customer_key").agg(F.count("*").alias("n"))
    return per_customer.agg(
        F.sum("n").alias("orders"),
        F.count("*").alias("customers"),
        ratio(F.sum("n"), F.count("*")).alias("avg_orders"),
    )


def revenue_distribution(orders: DataFrame, width: int = 500) -> DataFrame:
    """Known customers per band of spend; a band is named by its lower end."""
    band = (F.floor(F.col("spend") / F.lit(width)) * F.lit(width)).cast("bigint").alias("band_start")
    return _spend(orders).groupBy(band).agg(F.count("*").alias("customers")).orderBy("band_start")


def _segments(spend: DataFrame, low: Column, high: Column) -> DataFrame:
    segment = F.when(F.col("spend") <= low, "Low").when(F.col("spend") <= high, "Mid").otherwise("High")
    return spend.groupBy(segment.alias("segment")).agg(
        F.count("*").alias("customers"), F.sum("spend").cast(REVENUE).alias("revenue")
    )


def customer_segmentation(orders: DataFrame, low: int = 500, high: int = 2000) -> DataFrame:
    """Customers and revenue per segment, by fixed upper limits of Low and Mid."""
    return _segments(_spend(orders), F.lit(low), F.lit(high))


def customer_quartile_segments(orders: DataFrame) -> DataFrame:
    """Low up to the first, Mid up to the third quartile of spend, High above.

    The cut-offs are exact: the customers are ranked in parallel, and the spend
    at one and at three quarters of the ranks is read as two scalars.
    """
    ranked = surrogate_key(_spend(orders), ["spend"], "place", unique_rows=True)
    total = ranked.agg(F.max("place")).scalar()

    def spend_at(share: float) -> Column:
        return ranked.filter(F.col("place") == F.ceil(total * F.lit(share))).agg(F.max("spend")).scalar()

    return _segments(ranked, spend_at(0.25), spend_at(0.75))


def website_activity(events: DataFrame) -> DataFrame:
    counted = events.groupBy("date_key", "event_type").agg(F.count("*").alias("events"))
    return counted.orderBy(by("date_key"), by("event_type"))


def product_categories(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(F.count("*").alias("products")).orderBy(by("category"))


def resolution_rate(tickets: DataFrame, resolved: str = "resolved_date_key") -> DataFrame:
    """Tickets with a resolved date among all tickets.

    In the fact table a filled-in end counts as resolved; give the raw column
    to count the stated ends only.
    """
    done = F.count(resolved)
    return tickets.agg(
        F.count("*").alias("tickets"),
        done.alias("resolved"),
        percent(done, F.count("*")).alias("resolution_rate"),
    )


def avg_resolution_time(tickets: DataFrame) -> DataFrame:
    """Mean stated hours per issue type and overall (``scope`` tells which)."""
    rolled = tickets.rollup("issue_type").agg(
        F.grouping("issue_type").alias("_all"),
        F.count("*").alias("tickets"),
        mean("resolution_time_hours").alias("avg_hours"),
    )
    scope = F.when(F.col("_all") == 1, "overall").otherwise("issue_type").alias("scope")
    return rolled.select(scope, "issue_type", "tickets", "avg_hours").orderBy("scope", by("issue_type"))


def support_agents(tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Tickets and mean hours per agent; tickets without an agent stand under NULL."""
    per_key = tickets.groupBy("support_agent_key").agg(
        F.count("*").alias("tickets"), mean("resolution_time_hours").alias("avg_hours")
    )
    named = per_key.join(agents, "support_agent_key", "left")
    return named.select("support_agent", "tickets", "avg_hours").orderBy(by("support_agent"))


def customer_sentiment(tickets: DataFrame) -> DataFrame:
    """Tickets per sentiment and their share of all tickets.

    The total is a scalar subquery over the counts; it reads their exchange.
    """
    counted = tickets.groupBy("sentiment").agg(F.count("*").alias("tickets"))
    total = counted.agg(F.sum("tickets")).scalar()
    return counted.withColumn("share_pct", percent(F.col("tickets"), total)).orderBy(by("sentiment"))


def issue_types(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("issue_type").agg(F.count("*").alias("tickets")).orderBy(by("issue_type"))
