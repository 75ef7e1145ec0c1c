"""Bronze to silver.

Each table is one projection over its scan; only customers need a shuffle, for
one row per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.functions import (
    clean_agent,
    clean_amount,
    clean_person_name,
    clean_phone,
    clean_quantity,
    parse_date_multi,
    parse_ts_iso,
    parse_ts_lenient,
    standardize_category,
    standardize_issue,
    standardize_payment,
    standardize_sentiment,
    standardize_status,
    title_case,
)
from crispstar.operators.intervals import impute_interval, valid_intervals
from crispstar.operators.uniqueness import dedup_by_key


def silver_customers(bronze: DataFrame, keep_null_keys: bool = False) -> DataFrame:
    """Clean names, trimmed phone, one row per customer id."""
    cleaned = bronze.withColumns(
        {
            "first_name": clean_person_name("first_name"),
            "last_name": clean_person_name("last_name"),
            "phone_number": F.trim("phone_number"),
        }
    )
    return dedup_by_key(cleaned, "customer_id", keep_null_keys=keep_null_keys)


def with_clean_phones(silver: DataFrame) -> DataFrame:
    """Customers with the phone reduced to its number, the form the dimension takes."""
    return silver.withColumn("phone_number", clean_phone("phone_number"))


def silver_orders(bronze: DataFrame, draft: bool = False) -> DataFrame:
    """Typed quantity, amount and date; standard status and payment. Duplicates stay."""
    return bronze.select(
        "order_id",
        "customer_id",
        "product_id",
        clean_quantity("quantity").alias("quantity"),
        clean_amount("order_amount").alias("order_amount"),
        parse_date_multi("order_date").alias("order_date"),
        standardize_status("status", draft).alias("status"),
        standardize_payment("payment_method", draft).alias("payment_method"),
    )


def silver_products(bronze: DataFrame, variant: str = "published") -> DataFrame:
    """Trimmed name, standard category, decimal price. Negative and zero prices stay."""
    return bronze.select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        standardize_category("category", variant).alias("category"),
        clean_amount("price").alias("price"),
    )


def silver_tickets(bronze: DataFrame) -> DataFrame:
    """Standard issue, sentiment and agent; a missing end is filled from the other one.

    Undated and inverted tickets stay; ``valid_tickets`` drops them.
    """
    typed = bronze.select(
        "ticket_id",
        "customer_id",
        standardize_issue("issue_type").alias("issue_type"),
        parse_ts_iso("ticket_created").alias("ticket_created"),
        parse_ts_iso("ticket_resolved").alias("ticket_resolved"),
        "resolution_time_hours",
        standardize_sentiment("sentiment").alias("sentiment"),
        clean_agent("support_agent").alias("support_agent"),
    )
    return impute_interval(typed, "ticket_created", "ticket_resolved", "resolution_time_hours")


def valid_tickets(bronze: DataFrame) -> DataFrame:
    """Raw tickets with parsed dates, without those that have no date or end before they start."""
    dates = {c: parse_ts_iso(c) for c in ("ticket_created", "ticket_resolved")}
    return valid_intervals(bronze.withColumns(dates), *dates)


def silver_clickstream(bronze: DataFrame, version: int = 2) -> DataFrame:
    """Title-cased event type, trimmed url and device, parsed timestamp.

    Version 1 refuses fractional seconds and has no run id; version 2 reads any
    timestamp and keeps the run id.
    """
    parse, extra = {1: (parse_ts_iso, []), 2: (parse_ts_lenient, ["ingest_run_id"])}[version]
    return bronze.select(
        "event_id",
        "session_id",
        "customer_id",
        title_case("event_type").alias("event_type"),
        F.trim("page_url").alias("page_url"),
        F.trim("device_id").alias("device_id"),
        parse("timestamp").alias("timestamp"),
        *extra,
    )
