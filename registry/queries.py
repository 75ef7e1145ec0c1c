"""One query per operator, each over whole tables of the given folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crispstar import functions as fn
from crispstar.functions import text
from crispstar.functions.synonyms import STATUS
from crispstar.operators import completeness as comp
from crispstar.operators import rules, uniqueness, values
from crispstar.operators.incremental import incremental_load, load_partitions
from crispstar.operators.intervals import impute_interval
from crispstar.operators.keys import surrogate_key
from crispstar.plans import gold, kpi, silver
from crispstar.session import materialize, scratch_path
from crispstar.sources import landing, schemas, tables
from registry import more_queries, time_queries
from registry.tables import Layers

Query = Callable[[Layers], DataFrame]

AS_OF = dt.date(2024, 6, 1)
AS_OF_TIME = dt.datetime(2024, 1, 20)


# --- sources, sinks, table maintenance ------------------------------------


def _landed(t: Layers, name: str) -> str:
    """The bronze table as a headered CSV folder, blanks and empty strings kept."""
    path = scratch_path(t.spark, f"landing-{name}")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.bronze(name).write.options(header=True, **keep).csv(path)
    return path


def _csv_scan(t: Layers) -> DataFrame:
    return landing.csv_scan(t.spark, _landed(t, "orders"), schemas.ORDERS, bad_records="corrupt_record")


def _csv_scan_by_name(t: Layers) -> DataFrame:
    """Products whose columns stand in another order, beside one that is not declared; some lines have a field too many."""
    path = scratch_path(t.spark, "landing-products")
    quoted = [F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in ("category", "price", "product_name", "product_id")]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in quoted], F.lit("batch-1"))
    surplus = F.when(F.col("product_id").endswith("7"), F.lit(",surplus")).otherwise(F.lit(""))
    lines = t.bronze("products").select(F.concat(line, surplus).alias("category,price,product_name,product_id,batch"))
    # A quote that no text holds: the lines are written as they are.
    lines.write.options(header=True, sep="\x01", quote="\x02", escape="\x03").csv(path)
    scanned = landing.csv_scan(t.spark, path, schemas.PRODUCTS, bad_records="corrupt_record")
    return scanned.withColumn("corrupt_record", F.col("corrupt_record").isNotNull())


def _csv_scan_inferred(t: Layers) -> DataFrame:
    scanned = landing.csv_scan(t.spark, _landed(t, "tickets"))
    instants = [f.name for f in scanned.schema if f.dataType.typeName() == "timestamp"]
    return scanned.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def _sanitize_columns(t: Layers) -> DataFrame:
    raw = t.bronze("customers").withColumnsRenamed(
        {"device_id_s": "device_id(s)", "phone_number": " phone--number", "source": "_source_"}
    )
    return landing.sanitize_columns(raw)


def _bronze_load(t: Layers) -> DataFrame:
    base = scratch_path(t.spark, "landing")
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files = {"loaded_tickets": "tickets.csv", "loaded_clickstream": "clickstream.csv"}
    for name, file_name in files.items():
        t.bronze(name.removeprefix("loaded_")).write.options(**keep).csv(f"{base}/{file_name}")
    typed = {"loaded_tickets": schemas.TICKETS, "loaded_clickstream": schemas.CLICKSTREAM}
    names = landing.bronze_load(t.spark, files, base, location=f"{base}/tables", schemas=typed)
    tickets, events = (t.spark.table(n).withColumn("loaded", F.lit(n)) for n in names)
    return tickets.unionByName(events, allowMissingColumns=True)


def _publish_table(t: Layers) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    tables.publish(t.bronze("orders"), path, "create")
    return tables.publish(t.silver("orders"), path, "replace")


def _phone_history(t: Layers) -> str:
    """Silver customers with both phone updates and a restore to the first of them."""
    path = scratch_path(t.spark, "customers")
    tables.publish(t.silver("customers"), path, "create")
    tables.update_table(t.spark, path, "phone_number", text.phone_digits("phone_number"))
    tables.update_table(t.spark, path, "phone_number", text.drop_phone_prefix("phone_number"))
    tables.snapshot_restore(t.spark, path, 1)
    return path


def _update_column(t: Layers) -> DataFrame:
    path = scratch_path(t.spark, "customers")
    tables.publish(t.silver("customers"), path, "create")
    return tables.update_table(t.spark, path, "phone_number", fn.clean_phone("phone_number"))


# --- column functions: the key and the cleaned column of a bronze table ----


def _projection(table: str, *cols: str, **cleaned) -> Query:
    return lambda t: t.bronze(table).select(*cols, *[c().alias(n) for n, c in cleaned.items()])


# --- streaming --------------------------------------------------------------


def _incremental_load(t: Layers) -> DataFrame:
    """One market segment arrives again with cleaned names and replaces its customers."""
    raw = t.bronze("customers")
    batch = raw.filter("source = 'MACHINERY'").withColumn("first_name", fn.clean_person_name("first_name"))
    return incremental_load(raw, batch, "customer_id")


def _load_partitions(t: Layers) -> DataFrame:
    """Orders kept by payment method: a batch that is newer for some orders and older for others, and moves some of them."""
    path = scratch_path(t.spark, "orders-by-method")
    raw = uniqueness.dedup_by_key(t.bronze("orders"), "order_id").withColumn("revision", F.length("order_amount"))
    raw.write.partitionBy("payment_method").parquet(path)
    again = raw.filter("payment_method IN ('UPI', 'cash')").withColumn("status", F.lit("again"))
    again = again.withColumn("revision", F.lit(4))
    moved = F.when(F.col("order_id").endswith("1"), "voucher").otherwise(F.col("payment_method"))
    load_partitions(t.spark, path, again.withColumn("payment_method", moved), "order_id", "payment_method", newest_by="revision")
    return t.spark.read.schema(raw.schema).parquet(path)


def _order_rules() -> dict:
    return {
        "customer_known": F.col("customer_id").isNotNull(),
        "amount_positive": fn.as_number("order_amount") > 0,
        "date_parses": fn.parse_date_multi("order_date").isNotNull(),
        "status_standard": fn.standardize_status("status").isNotNull(),
    }


QUERIES: dict[str, Query] = {
    # sources, sinks, table maintenance
    "csv_scan": _csv_scan,
    "csv_scan_by_name": _csv_scan_by_name,
    "csv_scan_inferred": _csv_scan_inferred,
    "sanitize_columns": _sanitize_columns,
    "bronze_load": _bronze_load,
    "table_scan_preview": lambda t: values.preview(t.silver("customers"), 20, ("phone_number",)),
    "publish_table": _publish_table,
    "update_column": _update_column,
    "snapshot_history": lambda t: tables.snapshot_history(t.spark, _phone_history(t)),
    "snapshot_restore": lambda t: tables.read_table(t.spark, _phone_history(t)),
    "table_sample": lambda t: values.sample_rows(t.bronze("orders"), 1, 30, "order_id", seed=7),
    # completeness and uniqueness
    "row_count": lambda t: comp.row_count(t.bronze("orders")),
    "key_null_count": lambda t: comp.key_null_count(t.bronze("customers"), "customer_id"),
    "null_profile": lambda t: comp.null_profile(t.bronze("customers")),
    "empty_profile": lambda t: comp.null_profile(t.bronze("orders"), mode="empty"),
    "blank_profile": lambda t: comp.null_profile(t.bronze("clickstream"), mode="blank"),
    "blank_profile_typed": lambda t: comp.null_profile(t.silver("tickets"), mode="blank"),
    "null_rate": lambda t: comp.null_rate(t.bronze("clickstream"), "timestamp"),
    "valid_counts": lambda t: comp.valid_counts(t.silver("tickets"), ["ticket_created", "ticket_resolved"]),
    "null_combination": lambda t: comp.null_combination(
        t.silver("tickets"), "ticket_created", "ticket_resolved"
    ),
    "null_combination_parsed": lambda t: comp.null_combination(_parsed_tickets(t), "ticket_created", "ticket_resolved"),
    "null_rows": lambda t: comp.null_rows(t.bronze("clickstream"), "timestamp"),
    "null_share_by_group": lambda t: comp.null_share_by_group(t.bronze("clickstream"), "page_url", "event_type"),
    "duplicate_keys": lambda t: uniqueness.duplicate_keys(t.bronze("customers"), "customer_id"),
    "duplicate_key_count": lambda t: uniqueness.duplicate_key_count(t.bronze("orders"), "order_id"),
    "duplicate_key_pct": lambda t: uniqueness.duplicate_key_pct(t.bronze("customers"), "customer_id"),
    "duplicate_records": lambda t: uniqueness.duplicate_records(t.bronze("customers"), "customer_id"),
    "unique_records": lambda t: uniqueness.unique_records(t.bronze("customers"), "customer_id"),
    "unique_records_violations": lambda t: comp.row_count(
        rules.regex_violations(uniqueness.unique_records(t.bronze("customers"), "customer_id"), ["first_name"])
    ),
    "duplicate_group_nulls": lambda t: uniqueness.duplicate_group_nulls(
        t.bronze("customers"), "customer_id", "email"
    ),
    "duplicate_null_histogram": lambda t: uniqueness.duplicate_null_histogram(
        t.bronze("customers"), "customer_id", "email"
    ),
    "total_vs_distinct": lambda t: uniqueness.total_vs_distinct(t.bronze("customers"), "customer_id"),
    "distinct_count": lambda t: uniqueness.distinct_count(t.bronze("orders"), "customer_id"),
    "distinct_values": lambda t: uniqueness.distinct_values(t.silver("tickets"), "support_agent"),
    "surrogate_key_check": lambda t: uniqueness.surrogate_key_check(t.dim_customer, "customer_key"),
    # value and rule checks
    "value_frequency": lambda t: values.value_frequency(
        t.bronze("clickstream"), "event_type", where=F.col("page_url").isNull()
    ),
    "value_frequency_by_value": lambda t: values.value_frequency(t.silver("products"), "category", by_value=True),
    "top_values": lambda t: values.top_values(t.bronze("orders"), "order_amount"),
    "non_numeric_rate": lambda t: values.unparsable_rate(t.bronze("orders"), "quantity"),
    "non_numeric_values": lambda t: values.unparsable_values(t.bronze("orders"), "quantity"),
    "sentinel_rows": lambda t: values.sentinel_rows(t.bronze("orders"), "order_amount", -50),
    "sentinel_by_group": lambda t: values.sentinel_by_group(t.bronze("products"), "price", -100, "category"),
    "negative_count": lambda t: values.negative_count(t.bronze("products"), "price"),
    "negative_rows": lambda t: values.negative_rows(t.bronze("tickets"), "resolution_time_hours"),
    "negative_by_group": lambda t: values.negative_by_group(t.bronze("orders"), "order_amount", "status"),
    "negative_entities": lambda t: values.negative_entities(t.bronze("orders"), "order_amount", "product_id"),
    "negative_entity_pct": lambda t: values.negative_entity_pct(t.bronze("orders"), "order_amount", "customer_id"),
    "sign_flags": lambda t: values.sign_flags(t.bronze("orders"), "order_amount", "product_id"),
    "sign_flag_matrix": lambda t: values.sign_flag_matrix(t.bronze("orders"), "order_amount", "product_id"),
    "mixed_sign_groups": lambda t: values.mixed_sign_groups(t.bronze("orders"), "order_amount", "product_id"),
    "signed_counts": lambda t: values.signed_counts(t.bronze("orders"), "order_amount", "customer_id"),
    "sign_by_category": lambda t: values.sign_by_category(t.bronze("orders"), "order_amount", "payment_method"),
    "repeated_abs_amounts": lambda t: values.repeated_abs_amounts(t.bronze("orders")),
    "offset_pairs": lambda t: values.offset_pairs(t.bronze("orders")),
    "regex_violations": lambda t: rules.regex_violations(t.bronze("customers"), ["first_name", "last_name"]),
    "date_order_violations": lambda t: rules.date_order_violations(t.bronze("customers"), "dob", "signup_date"),
    "future_dates": lambda t: rules.future_dates(t.bronze("customers"), ["dob", "signup_date"], F.lit(AS_OF)),
    "future_dates_parsed": lambda t: rules.future_dates(
        t.bronze("tickets"), ["ticket_created", "ticket_resolved"], F.lit(AS_OF_TIME), fn.parse_ts_lenient
    ),
    "inverted_intervals": lambda t: rules.inverted_intervals(
        t.bronze("tickets"), "ticket_created", "ticket_resolved"
    ),
    "inverted_raw_strings": lambda t: rules.inverted_intervals(
        t.bronze("tickets"), "ticket_created", "ticket_resolved", parse=False
    ),
    "value_lookup": lambda t: values.value_lookup(
        t.bronze("orders"), "status", ["REF", "refunded"], ("customer_id", "order_date")
    ),
    "sorted_scan": lambda t: values.sorted_scan(materialize(t.silver("customers"), "customers"), "first_name"),
    "random_group": lambda t: values.random_group(t.bronze("orders"), "product_id", seed=3),
    "expected_amount": lambda t: rules.expected_amount(t.bronze("orders"), t.bronze("products")),
    "duration_hours": lambda t: rules.duration_hours(t.bronze("tickets")),
    "duration_reconcile": lambda t: rules.duration_reconcile(t.bronze("tickets")),
    "duration_reconcile_lenient": lambda t: rules.duration_reconcile(
        t.bronze("tickets"), parser=fn.parse_ts_lenient
    ),
    "duration_reconcile_multi": lambda t: rules.duration_reconcile(t.bronze("mixed_tickets"), parser=fn.parse_ts_multi),
    "duration_mismatches": lambda t: rules.duration_mismatches(t.bronze("tickets")),
    "fractional_values": lambda t: values.fractional_values(t.bronze("tickets"), "resolution_time_hours"),
    "length_histogram": lambda t: values.length_histogram(
        silver.with_clean_phones(t.silver("customers")), "phone_number"
    ),
    "length_lookup": lambda t: values.length_lookup(
        silver.with_clean_phones(t.silver("customers")), "phone_number", 7
    ),
    "date_span_union": lambda t: _date_span(t),
    # silver
    "clean_person_name": _projection(
        "customers",
        "customer_id",
        first_name=lambda: fn.clean_person_name("first_name"),
        last_name=lambda: fn.clean_person_name("last_name"),
    ),
    "dedup_by_key": lambda t: uniqueness.dedup_by_key(t.bronze("orders"), "order_id"),
    "dedup_by_key_keep_null": lambda t: uniqueness.dedup_by_key(
        t.bronze("customers"), "customer_id", [F.col("email").desc_nulls_last()], keep_null_keys=True
    ),
    "silver_customers": lambda t: t.silver("customers"),
    "clean_phone": _projection(
        "customers", "customer_id", "phone_number", cleaned=lambda: fn.clean_phone("phone_number")
    ),
    "clean_quantity": _projection("orders", "order_id", "quantity", cleaned=lambda: fn.clean_quantity("quantity")),
    "clean_amount": _projection(
        "orders", "order_id", "order_amount", cleaned=lambda: fn.clean_amount("order_amount")
    ),
    "parse_date_multi": _projection(
        "orders", "order_id", "order_date", cleaned=lambda: fn.parse_date_multi("order_date")
    ),
    "parse_ts_multi": _projection(
        "mixed_tickets", "ticket_id", "ticket_resolved", cleaned=lambda: fn.parse_ts_multi("ticket_resolved")
    ),
    "parse_ts_iso": _projection(
        "clickstream", "event_id", "timestamp", cleaned=lambda: fn.parse_ts_iso("timestamp")
    ),
    "map_synonyms": _projection(
        "orders",
        "order_id",
        as_null=lambda: fn.map_synonyms("status", STATUS, "null"),
        as_raw=lambda: fn.map_synonyms("status", STATUS, "raw"),
        as_normalized=lambda: fn.map_synonyms("status", STATUS, "normalized"),
    ),
    "synonym_join": lambda t: _synonym_join(t),
    "standardize_status": _projection(
        "orders",
        "order_id",
        cleaned=lambda: fn.standardize_status("status"),
        draft=lambda: fn.standardize_status("status", draft=True),
    ),
    "standardize_payment": _projection(
        "orders",
        "order_id",
        cleaned=lambda: fn.standardize_payment("payment_method"),
        draft=lambda: fn.standardize_payment("payment_method", draft=True),
    ),
    "silver_orders": lambda t: t.silver("orders"),
    "silver_orders_draft": lambda t: silver.silver_orders(t.bronze("orders"), draft=True),
    "standardize_category": _projection(
        "products",
        "product_id",
        published=lambda: fn.standardize_category("category"),
        draft=lambda: fn.standardize_category("category", "draft"),
        audit=lambda: fn.standardize_category("category", "audit"),
    ),
    "silver_products": lambda t: t.silver("products"),
    "standardize_issue": _projection("tickets", "ticket_id", cleaned=lambda: fn.standardize_issue("issue_type")),
    "standardize_sentiment": _projection(
        "tickets", "ticket_id", cleaned=lambda: fn.standardize_sentiment("sentiment")
    ),
    "clean_agent": _projection("tickets", "ticket_id", cleaned=lambda: fn.clean_agent("support_agent")),
    "impute_interval": lambda t: _impute(t),
    "silver_tickets": lambda t: t.silver("tickets"),
    "valid_ticket_filter": lambda t: silver.valid_tickets(t.bronze("tickets")),
    "silver_clickstream": lambda t: t.silver("clickstream"),
    "silver_clickstream_v1": lambda t: silver.silver_clickstream(t.bronze("clickstream"), version=1),
    # gold
    "surrogate_key": lambda t: surrogate_key(
        t.bronze("orders").select("order_amount", "order_id"), ["order_amount"], "amount_key"
    ),
    "dim_customer": lambda t: t.dim_customer,
    "dim_product": lambda t: t.dim_product,
    "dim_support_agent": lambda t: t.dim_support_agent,
    "dim_date": lambda t: gold.dim_date_between(_date_span(t)),
    "fact_orders": lambda t: t.fact_orders(),
    "fact_orders_v1": lambda t: t.fact_orders(version=1),
    "fact_orders_unknown_member": lambda t: t.fact_orders(unknown=True),
    "fact_orders_unique_products": lambda t: t.orders_once(),
    "fact_support_tickets": lambda t: t.fact_support_tickets(),
    "fact_support_tickets_v1": lambda t: t.fact_support_tickets(version=1),
    "fact_clickstream": lambda t: t.fact_clickstream(),
    "revenue_total": lambda t: gold.revenue_total(t.fact_orders()),
    "revenue_stats": lambda t: gold.revenue_stats(t.fact_orders()),
    "top_orders": lambda t: gold.top_orders(t.fact_orders()),
    # measures
    "kpi_overview": lambda t: kpi.kpi_overview(t.orders_once(), t.dim_customer, t.fact_clickstream()),
    "revenue_trend": lambda t: kpi.revenue_trend(t.orders_once(), t.dim_date),
    "order_trend": lambda t: kpi.order_trend(t.orders_once(), t.dim_date),
    "revenue_by_category": lambda t: _revenue_by_category(t),
    "customer_growth": lambda t: kpi.customer_growth(t.dim_customer),
    "avg_customer_spend": lambda t: kpi.avg_customer_spend(t.orders_once()),
    "avg_orders_per_customer": lambda t: kpi.avg_orders_per_customer(t.orders_once()),
    "revenue_distribution": lambda t: kpi.revenue_distribution(t.orders_once()),
    "customer_segmentation": lambda t: kpi.customer_segmentation(t.orders_once()),
    "customer_quartile_segments": lambda t: kpi.customer_quartile_segments(t.orders_once()),
    "website_activity": lambda t: kpi.website_activity(t.fact_clickstream()),
    "product_categories": lambda t: kpi.product_categories(t.dim_product),
    "resolution_rate": lambda t: kpi.resolution_rate(t.fact_support_tickets()),
    "resolution_rate_stated": lambda t: kpi.resolution_rate(t.bronze("tickets"), "ticket_resolved"),
    "avg_resolution_time": lambda t: kpi.avg_resolution_time(t.fact_support_tickets()),
    "ticket_volume": lambda t: kpi.ticket_volume(t.fact_support_tickets(), t.dim_date),
    "support_agents": lambda t: _support_agents(t),
    "customer_sentiment": lambda t: kpi.customer_sentiment(t.fact_support_tickets()),
    "issue_types": lambda t: kpi.issue_types(t.fact_support_tickets()),
    # announced extensions
    "incremental_load": _incremental_load,
    "load_partitions": _load_partitions,
    "quality_rules": lambda t: rules.quality_rules(t.bronze("orders"), _order_rules()),
    "quality_quarantine": lambda t: _quarantine(t),
    **time_queries.QUERIES,
    **more_queries.QUERIES,
}


def _date_span(t: Layers) -> DataFrame:
    tickets = t.silver("tickets")
    return rules.date_span(
        [
            (t.silver("customers"), "signup_date"),
            (t.silver("orders"), "order_date"),
            (tickets, "ticket_created"),
            (tickets, "ticket_resolved"),
            (t.silver("clickstream"), "timestamp"),
        ]
    )


def _synonym_join(t: Layers) -> DataFrame:
    """Market segments abbreviated through a mapping table taken from the customers themselves."""
    customers = t.bronze("customers")
    source = F.col("source")
    mapping = customers.select(F.lower(source).alias("spelling"), F.substring(source, 1, 3).alias("short")).distinct()
    short = fn.synonym_join(customers, "source", mapping.filter("short <> 'MAC'"), "spelling", "short", "raw")
    return short.select("customer_id", "email", "source")


def _parsed_tickets(t: Layers) -> DataFrame:
    """Tickets with both ends parsed and none filled in."""
    return t.bronze("tickets").withColumns({c: fn.parse_ts_iso(c) for c in ("ticket_created", "ticket_resolved")})


def _impute(t: Layers) -> DataFrame:
    filled = impute_interval(_parsed_tickets(t), "ticket_created", "ticket_resolved", "resolution_time_hours")
    return filled.select("ticket_id", "resolution_time_hours", "ticket_created", "ticket_resolved")


def _revenue_by_category(t: Layers) -> DataFrame:
    products = t.dim_product
    return kpi.revenue_by_category(t.orders_once(), products)


def _support_agents(t: Layers) -> DataFrame:
    agents = t.dim_support_agent
    tickets = gold.fact_support_tickets(t.silver("tickets"), t.dim_customer, agents, t.dim_date)
    return kpi.support_agents(tickets, agents)


def _quarantine(t: Layers) -> DataFrame:
    failed = rules.quarantine(t.bronze("orders"), _order_rules())
    return failed.withColumn("failed_rules", F.array_join("failed_rules", ","))


def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Layers(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(query) for name, query in QUERIES.items()}
