"""DuckDB statements that compute what the registered queries compute.

They share the spelling tables (fixed values) and the derivation of the bronze
tables with the Spark side and nothing else: keys are numbered by a window,
dates are matched by range instead of by the date dimension, and measures are
taken from silver tables rather than from facts wherever that is possible.
"""

from __future__ import annotations

from crispstar.functions.synonyms import (
    CATEGORY,
    CATEGORY_DRAFT,
    ISSUE,
    PAYMENT,
    PAYMENT_DRAFT,
    SENTIMENT,
    STATUS,
    STATUS_DRAFT,
)
from registry.bronze import BRONZE_SQL, bronze_check_sql

# --- fragments ---------------------------------------------------------------


def spelled(col: str, table: dict[str, tuple[str, ...]]) -> str:
    pairs = ", ".join(f"'{s}': '{value}'" for value, spellings in table.items() for s in spellings)
    return f"map_extract_value(MAP {{{pairs}}}, lower(trim({col})))"


def titled(expr: str) -> str:
    words = f"string_split(trim({expr}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def integer(col: str) -> str:
    """Text that is an integer; DuckDB itself would also take '2.5' and '1e3'."""
    return f"CASE WHEN regexp_full_match(trim({col}), '[+-]?[0-9]+') THEN try_cast(trim({col}) AS INTEGER) END"


def plain_double(col: str) -> str:
    return f"try_cast({col} AS DOUBLE)"


def comma_double(col: str) -> str:
    return f"try_cast(replace({col}, ',', '') AS DOUBLE)"


def quantity(col: str) -> str:
    return (
        f"CASE WHEN trim(lower({col})) = 'five' THEN 5 WHEN trim({col}) = '2.0' THEN 2"
        f" ELSE nullif({integer(col)}, -3) END"
    )


def money(col: str) -> str:
    return f"try_cast(replace({col}, ',', '') AS DECIMAL(10,2))"


def strict(expr: str, shape: str, layout: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, '{shape}') THEN try_strptime({expr}, '{layout}') END"


def iso_ts(col: str) -> str:
    return strict(f"replace({col}, 'T', ' ')", r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", "%Y-%m-%d %H:%M:%S")


def multi_ts(col: str) -> str:
    return (
        f"coalesce({strict(col, r'\d{4}-\d\d-\d\d \d\d:\d\d:\d\d', '%Y-%m-%d %H:%M:%S')},"
        f" {strict(col, r'\d\d/\d\d/\d{4} \d\d:\d\d', '%m/%d/%Y %H:%M')},"
        f" {strict(col, r'\d\d-\d\d-\d{4} \d\d:\d\d', '%d-%m-%Y %H:%M')})"
    )


def any_ts(col: str) -> str:
    return f"try_cast({col} AS TIMESTAMP)"


def any_date(col: str) -> str:
    return (
        f"CAST(coalesce({strict(col, r'\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{1,6}', '%Y-%m-%dT%H:%M:%S.%f')},"
        f" {strict(col, r'\d{4}-\d\d-\d\d', '%Y-%m-%d')},"
        f" {strict(col, r'\d\d-\d\d-\d{4}', '%d-%m-%Y')}) AS DATE)"
    )


def phone_digits(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, 'x.*$', ''), '[^0-9]', '', 'g')"


def short_phone(col: str) -> str:
    d = phone_digits(col)
    return (
        f"CASE WHEN length({d}) = 13 AND starts_with({d}, '001') THEN {d}[4:]"
        f" WHEN length({d}) = 11 AND starts_with({d}, '1') THEN {d}[2:] ELSE {d} END"
    )


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage rounded half up in whole numbers; both counts are non-negative."""
    scale = 10**digits
    return f"(CAST({200 * scale} * ({part}) + ({whole}) AS HUGEINT) // (2 * ({whole}))) / CAST({scale} AS DOUBLE)"


def hours(start: str, end: str) -> str:
    """Seconds / 3600 rounded half away from zero, in whole numbers."""
    s = f"(epoch_us(date_trunc('second', {end})) - epoch_us(date_trunc('second', {start}))) // 1000000"
    return f"sign({s}) * ((200 * abs({s}) + 3600) // 7200) / CAST(100 AS DOUBLE)"


def first(*cols: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def day_key(col: str) -> str:
    """The date key of a date inside the calendar, else NULL."""
    return (
        f"CASE WHEN {col} BETWEEN DATE '2013-01-01' AND DATE '2027-12-31'"
        f" THEN CAST(strftime({col}, '%Y%m%d') AS INTEGER) END"
    )


def in_calendar(col: str) -> str:
    return f"CASE WHEN {col} BETWEEN DATE '2013-01-01' AND DATE '2027-12-31' THEN {col} END"


CUSTOMER_REST = (
    "first_name last_name email phone_number gender dob signup_date address city state country device_id_s source"
).split()

# --- shared tables, each with the tables it reads ----------------------------

SHARED: dict[str, tuple[tuple[str, ...], str]] = {
    **{name: ((), bronze_check_sql(name)) for name in BRONZE_SQL},
    "customers_cleaned": (
        ("bronze_customers",),
        f"""SELECT * REPLACE ({titled("regexp_replace(first_name, '[0-9]', '', 'g')")} AS first_name,
            {titled("regexp_replace(last_name, '[0-9]', '', 'g')")} AS last_name,
            trim(phone_number) AS phone_number) FROM bronze_customers""",
    ),
    "silver_customers": (
        ("customers_cleaned",),
        f"""SELECT DISTINCT ON (customer_id) * FROM customers_cleaned
            ORDER BY customer_id, {first(*CUSTOMER_REST)}""",
    ),
    "phoned_customers": (
        ("silver_customers",),
        f"SELECT * REPLACE ({short_phone('phone_number')} AS phone_number) FROM silver_customers",
    ),
    "silver_orders": (
        ("bronze_orders",),
        f"""SELECT order_id, customer_id, product_id, {quantity("quantity")} AS quantity,
            {money("order_amount")} AS order_amount, {any_date("order_date")} AS order_date,
            {spelled("status", STATUS)} AS status, {spelled("payment_method", PAYMENT)} AS payment_method
            FROM bronze_orders""",
    ),
    "silver_products": (
        ("bronze_products",),
        f"""SELECT product_id, trim(product_name) AS product_name,
            coalesce({spelled("category", CATEGORY)}, category) AS category, {money("price")} AS price
            FROM bronze_products""",
    ),
    "parsed_tickets": (
        ("bronze_tickets",),
        f"""SELECT * REPLACE ({iso_ts("ticket_created")} AS ticket_created,
            {iso_ts("ticket_resolved")} AS ticket_resolved) FROM bronze_tickets""",
    ),
    "filled_tickets": (
        ("parsed_tickets",),
        """SELECT * REPLACE (
            coalesce(ticket_created, ticket_resolved - to_hours(CAST(trunc(resolution_time_hours) AS INTEGER))) AS ticket_created,
            coalesce(ticket_resolved, ticket_created + to_hours(CAST(trunc(resolution_time_hours) AS INTEGER))) AS ticket_resolved)
            FROM parsed_tickets""",
    ),
    "silver_tickets": (
        ("filled_tickets",),
        f"""SELECT ticket_id, customer_id, {spelled("issue_type", ISSUE)} AS issue_type, ticket_created,
            ticket_resolved, resolution_time_hours, {spelled("sentiment", SENTIMENT)} AS sentiment,
            {titled("regexp_replace(support_agent, '[^A-Za-z ]', '', 'g')")} AS support_agent
            FROM filled_tickets""",
    ),
    "silver_clickstream": (
        ("bronze_clickstream",),
        f"""SELECT event_id, session_id, customer_id, {titled("event_type")} AS event_type,
            trim(page_url) AS page_url, trim(device_id) AS device_id, {any_ts("timestamp")} AS timestamp,
            ingest_run_id FROM bronze_clickstream""",
    ),
    "dim_customer": (
        ("phoned_customers",),
        """SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key,
            * EXCLUDE (address, device_id_s) FROM phoned_customers""",
    ),
    "dim_product": (
        ("silver_products",),
        f"""SELECT row_number() OVER (ORDER BY {first("product_id", "product_name", "category", "price")})
            AS product_key, * FROM silver_products""",
    ),
    "dim_support_agent": (
        ("silver_tickets",),
        """SELECT row_number() OVER (ORDER BY support_agent) AS support_agent_key, support_agent
            FROM (SELECT support_agent FROM silver_tickets WHERE support_agent IS NOT NULL GROUP BY ALL)""",
    ),
    "fact_orders": (
        ("silver_orders", "dim_customer", "dim_product"),
        f"""SELECT order_id, customer_key, product_key, {day_key("order_date")} AS date_key, quantity,
            order_amount, payment_method, status FROM silver_orders
            LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)
            LEFT JOIN (SELECT product_id, product_key FROM dim_product) USING (product_id)""",
    ),
    "fact_support_tickets": (
        ("silver_tickets", "dim_customer", "dim_support_agent"),
        f"""SELECT ticket_id, customer_key, {day_key("CAST(ticket_created AS DATE)")} AS created_date_key,
            {day_key("CAST(ticket_resolved AS DATE)")} AS resolved_date_key, support_agent_key, issue_type,
            sentiment, resolution_time_hours FROM silver_tickets
            LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)
            LEFT JOIN dim_support_agent USING (support_agent)""",
    ),
    "fact_clickstream": (
        ("silver_clickstream", "dim_customer"),
        f"""SELECT event_id, customer_key, {day_key("CAST(timestamp AS DATE)")} AS date_key, event_type
            FROM silver_clickstream
            LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)""",
    ),
    # Orders with one row per matching product.
    "sales": (
        ("silver_orders", "silver_products", "silver_customers"),
        f"""SELECT o.*, p.category, c.customer_id AS known_customer, {in_calendar("o.order_date")} AS day
            FROM silver_orders o LEFT JOIN silver_products p ON o.product_id = p.product_id
            LEFT JOIN (SELECT customer_id FROM silver_customers WHERE customer_id IS NOT NULL) c
            ON o.customer_id = c.customer_id""",
    ),
    # Orders as the measures see them: each once, whatever products there are.
    "sold": (
        ("silver_orders", "silver_customers"),
        f"""SELECT o.*, c.customer_id AS known_customer, {in_calendar("o.order_date")} AS day FROM silver_orders o
            LEFT JOIN (SELECT customer_id FROM silver_customers WHERE customer_id IS NOT NULL) c
            ON o.customer_id = c.customer_id""",
    ),
    "first_products": (
        ("dim_product",),
        """SELECT product_id, product_key, category FROM dim_product WHERE product_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_key) = 1""",
    ),
    "spend": (
        ("sold",),
        """SELECT known_customer, CAST(coalesce(sum(order_amount), 0) AS DECIMAL(20,2)) AS spend FROM sold
            WHERE status = 'success' AND known_customer IS NOT NULL GROUP BY ALL""",
    ),
    "span": (
        ("silver_customers", "silver_orders", "silver_tickets", "silver_clickstream"),
        """SELECT min(d) AS start_date, max(d) AS end_date FROM (
            SELECT signup_date AS d FROM silver_customers UNION ALL SELECT order_date FROM silver_orders
            UNION ALL SELECT CAST(ticket_created AS DATE) FROM silver_tickets
            UNION ALL SELECT CAST(ticket_resolved AS DATE) FROM silver_tickets
            UNION ALL SELECT CAST(timestamp AS DATE) FROM silver_clickstream)""",
    ),
    "repeated_customers": (
        ("bronze_customers",),
        "SELECT customer_id, count(*) AS records, count(*) - count(email) AS null_values FROM bronze_customers"
        " GROUP BY customer_id HAVING count(*) >= 2",
    ),
    "order_signs": (
        ("bronze_orders",),
        f"""SELECT *, {plain_double("order_amount")} AS v, coalesce({plain_double("order_amount")} < 0, false) AS neg,
            coalesce({plain_double("order_amount")} > 0, false) AS pos FROM bronze_orders""",
    ),
    "product_signs": (
        ("order_signs",),
        """SELECT product_id, CAST(bool_or(neg) AS INTEGER) AS has_negative,
            CAST(bool_or(pos) AS INTEGER) AS has_positive FROM order_signs GROUP BY product_id""",
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        _needed(SHARED[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def over(*names_and_body: str) -> str:
    """The last argument as a statement over the shared tables named before it."""
    *names, body = names_and_body
    parts = ",\n".join(f"{n} AS ({SHARED[n][1]})" for n in _needed(tuple(names), []))
    return f"WITH {parts}\n{body}"


def table(name: str) -> str:
    return over(name, f"SELECT * FROM {name}")


def nulls(cols: str, missing: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {missing.format(c=c)}) AS {c}_nulls" for c in cols.split())


CUSTOMER_COLS = " ".join(["customer_id", *CUSTOMER_REST])
ORDER_COLS = "order_id customer_id product_id quantity order_amount order_date status payment_method"
CLICK_COLS = "event_id session_id customer_id event_type page_url device_id timestamp ingest_run_id"
TICKET_COLS = (
    "ticket_id customer_id issue_type ticket_created ticket_resolved resolution_time_hours sentiment support_agent"
)
PHONE_LOG = [(0, "create"), (1, "update"), (2, "update"), (3, "restore")]


def reconcile(parse, tickets: str = "bronze_tickets") -> str:
    return over(
        tickets,
        f"""SELECT count(*) AS total_checked, count(*) FILTER (WHERE calc = stated) AS matched,
        count(*) FILTER (WHERE calc <> stated) AS mismatched FROM (
          SELECT {hours("s", "e")} AS calc, round(resolution_time_hours, 2) AS stated FROM (
            SELECT {parse("ticket_created")} AS s, {parse("ticket_resolved")} AS e, resolution_time_hours
            FROM {tickets}) WHERE s <= e)""",
    )


def per_month(measure: str, source: str, day: str, where: str = "true") -> str:
    return f"""SELECT CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month, {measure}
        FROM {source} WHERE {where} GROUP BY ALL"""


SEGMENT_SUMS = "count(*) AS customers, CAST(sum(spend) AS DECIMAL(20,2)) AS revenue"

ORDER_RULES = {
    "customer_known": "customer_id IS NOT NULL",
    "amount_positive": f"{comma_double('order_amount')} > 0",
    "date_parses": f"{any_date('order_date')} IS NOT NULL",
    "status_standard": f"{spelled('status', STATUS)} IS NOT NULL",
}

CHECKS: dict[str, str] = {
    # sources, sinks, table maintenance
    # A CSV cannot tell an empty string from a missing one: both are read as NULL.
    "csv_scan": over("bronze_orders", """SELECT * REPLACE (nullif(quantity, '') AS quantity),
        CAST(NULL AS VARCHAR) AS corrupt_record FROM bronze_orders"""),
    "csv_scan_by_name": over(
        "bronze_products", "SELECT *, product_id LIKE '%7' AS corrupt_record FROM bronze_products"
    ),
    "csv_scan_inferred": over(
        "bronze_tickets",
        """SELECT * REPLACE (CAST(ticket_created AS TIMESTAMP) AS ticket_created,
        CAST(ticket_resolved AS TIMESTAMP) AS ticket_resolved) FROM bronze_tickets""",
    ),
    "sanitize_columns": table("bronze_customers"),
    "bronze_load": over(
        "bronze_tickets",
        "bronze_clickstream",
        """SELECT *, CAST(NULL AS VARCHAR) AS corrupt_record, 'default.loaded_tickets' AS loaded FROM bronze_tickets
        UNION ALL BY NAME
        SELECT *, CAST(NULL AS VARCHAR) AS corrupt_record, 'default.loaded_clickstream' AS loaded FROM bronze_clickstream""",
    ),
    "table_scan_preview": over(
        "silver_customers",
        f"""SELECT * FROM silver_customers
        ORDER BY {first("phone_number", *[c for c in CUSTOMER_COLS.split() if c != "phone_number"])} LIMIT 20""",
    ),
    "publish_table": table("silver_orders"),
    "update_column": table("phoned_customers"),
    "snapshot_history": over(
        "silver_customers",
        f"""SELECT CAST(version AS INTEGER) AS version, operation, (SELECT count(*) FROM silver_customers) AS n_rows
        FROM (VALUES {", ".join(str(row) for row in PHONE_LOG)}) log(version, operation)""",
    ),
    "snapshot_restore": over(
        "silver_customers",
        f"SELECT * REPLACE ({phone_digits('phone_number')} AS phone_number) FROM silver_customers",
    ),
    "table_sample": over(
        "bronze_orders",
        f"""SELECT * EXCLUDE (h) FROM (SELECT *, md5(order_id || '#7') AS h FROM bronze_orders)
        WHERE h[1:8] < '{int(0.01 * 16**8):08x}' ORDER BY h, {first(*ORDER_COLS.split())} LIMIT 30""",
    ),
    # completeness and uniqueness
    "row_count": over("bronze_orders", "SELECT count(*) AS total_rows FROM bronze_orders"),
    "key_null_count": over(
        "bronze_customers", "SELECT count(*) - count(customer_id) AS null_keys FROM bronze_customers"
    ),
    "null_profile": over("bronze_customers", f"SELECT {nulls(CUSTOMER_COLS, '{c} IS NULL')} FROM bronze_customers"),
    "empty_profile": over("bronze_orders", f"SELECT {nulls(ORDER_COLS, "coalesce({c}, '') = ''")} FROM bronze_orders"),
    "blank_profile": over(
        "bronze_clickstream", f"SELECT {nulls(CLICK_COLS, "coalesce(trim({c}), '') = ''")} FROM bronze_clickstream"
    ),
    "blank_profile_typed": over(
        "silver_tickets",
        f"SELECT {nulls(TICKET_COLS, "coalesce(trim(CAST({c} AS VARCHAR)), '') = ''")} FROM silver_tickets",
    ),
    "null_rate": over(
        "bronze_clickstream",
        f"""SELECT count(*) AS total_records, count(*) - count(timestamp) AS null_records,
        {pct("count(*) - count(timestamp)", "count(*)")} AS null_percentage FROM bronze_clickstream""",
    ),
    "valid_counts": over(
        "silver_tickets",
        """SELECT count(*) AS total_rows, count(ticket_created) AS ticket_created_set,
        count(*) FILTER (WHERE ticket_created IS NULL) AS ticket_created_missing,
        count(ticket_resolved) AS ticket_resolved_set,
        count(*) FILTER (WHERE ticket_resolved IS NULL) AS ticket_resolved_missing FROM silver_tickets""",
    ),
    "null_combination": over(
        "silver_tickets",
        """SELECT count(*) FILTER (WHERE coalesce(ticket_created, ticket_resolved) IS NULL) AS both_missing,
        count(ticket_resolved) FILTER (WHERE ticket_created IS NULL) AS first_missing,
        count(ticket_created) FILTER (WHERE ticket_resolved IS NULL) AS second_missing FROM silver_tickets""",
    ),
    "null_combination_parsed": over(
        "bronze_tickets",
        f"""SELECT count(*) FILTER (WHERE coalesce(s, e) IS NULL) AS both_missing,
        count(e) FILTER (WHERE s IS NULL) AS first_missing, count(s) FILTER (WHERE e IS NULL) AS second_missing
        FROM (SELECT {iso_ts("ticket_created")} AS s, {iso_ts("ticket_resolved")} AS e FROM bronze_tickets)""",
    ),
    "null_rows": over("bronze_clickstream", "SELECT * FROM bronze_clickstream WHERE timestamp IS NULL"),
    "null_share_by_group": over(
        "bronze_clickstream",
        f"""SELECT event_type, n AS null_records, {pct("n", "CAST(sum(n) OVER () AS BIGINT)")} AS null_percentage
        FROM (SELECT event_type, count(*) AS n FROM bronze_clickstream WHERE page_url IS NULL GROUP BY event_type)""",
    ),
    "duplicate_keys": over("repeated_customers", "SELECT customer_id, records FROM repeated_customers"),
    "duplicate_key_count": over(
        "bronze_orders",
        """SELECT count(*) AS duplicate_keys FROM
        (SELECT order_id FROM bronze_orders GROUP BY order_id HAVING count(*) >= 2)""",
    ),
    "duplicate_key_pct": over(
        "bronze_customers",
        "repeated_customers",
        f"""SELECT d AS duplicate_keys, n AS total_rows, {pct("d", "n")} AS duplicate_percentage FROM
        (SELECT (SELECT count(*) FROM repeated_customers) AS d, (SELECT count(*) FROM bronze_customers) AS n)""",
    ),
    "duplicate_records": over(
        "repeated_customers",
        "SELECT * FROM bronze_customers WHERE customer_id IN (SELECT customer_id FROM repeated_customers)",
    ),
    "unique_records": over(
        "bronze_customers",
        """SELECT * FROM bronze_customers
        QUALIFY customer_id IS NULL OR count(*) OVER (PARTITION BY customer_id) = 1""",
    ),
    "unique_records_violations": over(
        "bronze_customers",
        """SELECT count(*) FILTER (WHERE regexp_matches(first_name, '[0-9]')) AS total_rows FROM
        (SELECT * FROM bronze_customers QUALIFY customer_id IS NULL OR count(*) OVER (PARTITION BY customer_id) = 1)""",
    ),
    "duplicate_group_nulls": over(
        "repeated_customers", "SELECT * FROM repeated_customers WHERE customer_id IS NOT NULL"
    ),
    "duplicate_null_histogram": over(
        "repeated_customers",
        """SELECT null_values, count(*) AS keys FROM repeated_customers
        WHERE customer_id IS NOT NULL GROUP BY null_values""",
    ),
    "total_vs_distinct": over(
        "bronze_customers",
        "SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS unique_keys FROM bronze_customers",
    ),
    "distinct_count": over(
        "bronze_orders",
        "SELECT count(*) AS distinct_values FROM (SELECT customer_id FROM bronze_orders GROUP BY customer_id)",
    ),
    "distinct_values": over("silver_tickets", "SELECT support_agent FROM silver_tickets GROUP BY support_agent"),
    "surrogate_key_check": over(
        "dim_customer",
        """SELECT min(customer_key) AS min_key, max(customer_key) AS max_key,
        count(DISTINCT customer_key) AS distinct_keys, count(*) AS total_rows FROM dim_customer""",
    ),
    # value and rule checks
    "value_frequency": over(
        "bronze_clickstream",
        "SELECT event_type, count(*) AS cnt FROM bronze_clickstream WHERE page_url IS NULL GROUP BY event_type",
    ),
    "value_frequency_by_value": over(
        "silver_products", "SELECT category, count(*) AS cnt FROM silver_products GROUP BY category"
    ),
    "top_values": over(
        "bronze_orders",
        """SELECT order_amount, count(*) AS cnt FROM bronze_orders GROUP BY order_amount
        ORDER BY cnt DESC, order_amount NULLS FIRST LIMIT 20""",
    ),
    "non_numeric_rate": over(
        "bronze_orders",
        f"""SELECT n AS total_rows, bad AS unparsable_rows, {pct("bad", "n")} AS percentage FROM
        (SELECT count(*) AS n, count(*) FILTER (WHERE ({integer("quantity")}) IS NULL) AS bad FROM bronze_orders)""",
    ),
    "non_numeric_values": over(
        "bronze_orders",
        f"""SELECT quantity, count(*) AS cnt FROM bronze_orders WHERE ({integer("quantity")}) IS NULL
        GROUP BY quantity""",
    ),
    "sentinel_rows": over(
        "bronze_orders", f"SELECT * FROM bronze_orders WHERE {comma_double('order_amount')} = -50"
    ),
    "sentinel_by_group": over(
        "bronze_products",
        f"""SELECT category, count(*) AS cnt FROM bronze_products WHERE {comma_double("price")} = -100
        GROUP BY category""",
    ),
    "negative_count": over(
        "bronze_products",
        f"SELECT count(*) FILTER (WHERE {comma_double('price')} < 0) AS negative_values FROM bronze_products",
    ),
    "negative_rows": over("bronze_tickets", "SELECT * FROM bronze_tickets WHERE sign(resolution_time_hours) = -1"),
    "negative_by_group": over(
        "order_signs", "SELECT status, count(*) AS negative_rows FROM order_signs WHERE neg GROUP BY status"
    ),
    "negative_entities": over("order_signs", "SELECT product_id FROM order_signs WHERE neg GROUP BY product_id"),
    "negative_entity_pct": over(
        "order_signs",
        f"""SELECT d AS negative_entities, n AS total_entities, {pct("d", "n")} AS percentage FROM
        (SELECT count(*) AS n, count(*) FILTER (WHERE neg) AS d FROM
          (SELECT customer_id, bool_or(neg) AS neg FROM order_signs GROUP BY customer_id))""",
    ),
    "sign_flags": table("product_signs"),
    "sign_flag_matrix": over(
        "product_signs", "SELECT has_negative, has_positive, count(*) AS cnt FROM product_signs GROUP BY ALL"
    ),
    "mixed_sign_groups": over(
        "product_signs", "SELECT * FROM product_signs WHERE has_negative + has_positive = 2"
    ),
    "signed_counts": over(
        "order_signs",
        """SELECT customer_id, count(*) FILTER (WHERE neg) AS negative_orders,
        count(*) FILTER (WHERE NOT neg) AS positive_orders FROM order_signs GROUP BY customer_id""",
    ),
    "sign_by_category": over(
        "order_signs",
        """SELECT payment_method, if(neg, 'Negative', 'Positive') AS amount_type, count(*) AS orders
        FROM order_signs GROUP BY ALL""",
    ),
    "repeated_abs_amounts": over(
        "order_signs",
        """SELECT product_id, abs(v) AS abs_amount, count(*) AS cnt FROM order_signs
        GROUP BY ALL HAVING count(*) >= 2""",
    ),
    "offset_pairs": over(
        "order_signs",
        """SELECT product_id, abs(v) AS abs_amount, 1 AS has_positive, 1 AS has_negative FROM order_signs
        GROUP BY product_id, abs(v) HAVING bool_or(pos) AND bool_or(neg)""",
    ),
    "regex_violations": over(
        "bronze_customers",
        "SELECT * FROM bronze_customers WHERE regexp_matches(concat(first_name, last_name), '[0-9]')",
    ),
    "date_order_violations": over(
        "bronze_customers", "SELECT * FROM bronze_customers WHERE signup_date - dob < 0"
    ),
    "future_dates": over(
        "bronze_customers",
        "SELECT * FROM bronze_customers WHERE greatest(dob, signup_date) > DATE '2024-06-01'",
    ),
    "future_dates_parsed": over(
        "bronze_tickets",
        f"""SELECT * FROM bronze_tickets
        WHERE greatest({any_ts("ticket_created")}, {any_ts("ticket_resolved")}) > TIMESTAMP '2024-01-20 00:00:00'""",
    ),
    "inverted_intervals": over(
        "bronze_tickets",
        f"SELECT * FROM bronze_tickets WHERE {any_ts('ticket_resolved')} < {any_ts('ticket_created')}",
    ),
    "inverted_raw_strings": over(
        "bronze_tickets", "SELECT * FROM bronze_tickets WHERE ticket_resolved < ticket_created"
    ),
    "value_lookup": over(
        "bronze_orders", "SELECT * FROM bronze_orders WHERE regexp_full_match(trim(status), 'REF|refunded')"
    ),
    "sorted_scan": table("silver_customers"),
    "random_group": over(
        "bronze_orders",
        """SELECT product_id, count(*) AS orders_count FROM bronze_orders GROUP BY product_id
        ORDER BY md5(coalesce(product_id, '') || '#3'), product_id NULLS FIRST LIMIT 1""",
    ),
    "expected_amount": over(
        "bronze_orders",
        "bronze_products",
        f"""SELECT *, unit_price * qty AS expected_amount FROM (
          SELECT order_id, product_id, quantity, price, order_amount, {comma_double("price")} AS unit_price,
          {integer("quantity")} AS qty FROM bronze_products JOIN bronze_orders USING (product_id))""",
    ),
    "duration_hours": over(
        "bronze_tickets",
        f"""SELECT *, {hours(any_ts("ticket_created"), any_ts("ticket_resolved"))} AS calculated_hours
        FROM bronze_tickets WHERE ticket_created IS NOT NULL AND ticket_resolved IS NOT NULL""",
    ),
    "duration_reconcile": reconcile(iso_ts),
    "duration_reconcile_lenient": reconcile(any_ts),
    "duration_reconcile_multi": reconcile(multi_ts, "bronze_mixed_tickets"),
    "duration_mismatches": over(
        "bronze_tickets",
        f"""SELECT *, {hours(any_ts("ticket_created"), any_ts("ticket_resolved"))} AS calculated_hours
        FROM bronze_tickets WHERE {any_ts("ticket_resolved")} >= {any_ts("ticket_created")}
        AND calculated_hours <> round(resolution_time_hours, 2)""",
    ),
    "fractional_values": over(
        "bronze_tickets",
        """SELECT min(h) AS min_value, max(h) AS max_value, count(*) AS cnt FROM
        (SELECT resolution_time_hours AS h FROM bronze_tickets) WHERE trunc(h) <> h""",
    ),
    "length_histogram": over(
        "phoned_customers",
        """SELECT CAST(length(phone_number) AS INTEGER) AS length, count(*) AS cnt
        FROM phoned_customers GROUP BY ALL""",
    ),
    "length_lookup": over("phoned_customers", "SELECT * FROM phoned_customers WHERE phone_number LIKE '_______'"),
    "date_span_union": table("span"),
    # silver
    "clean_person_name": over("customers_cleaned", "SELECT customer_id, first_name, last_name FROM customers_cleaned"),
    "dedup_by_key": over(
        "bronze_orders",
        f"""SELECT DISTINCT ON (order_id) * FROM bronze_orders
        ORDER BY order_id, {first(*ORDER_COLS.split()[1:])}""",
    ),
    "dedup_by_key_keep_null": over(
        "bronze_customers",
        f"""SELECT * FROM (SELECT DISTINCT ON (customer_id) * FROM bronze_customers WHERE customer_id IS NOT NULL
        ORDER BY customer_id, email DESC NULLS LAST, {first(*CUSTOMER_REST)})
        UNION ALL SELECT * FROM bronze_customers WHERE customer_id IS NULL""",
    ),
    "silver_customers": table("silver_customers"),
    "clean_phone": over(
        "bronze_customers",
        f"SELECT customer_id, phone_number, {short_phone('phone_number')} AS cleaned FROM bronze_customers",
    ),
    "clean_quantity": over(
        "bronze_orders", f"SELECT order_id, quantity, {quantity('quantity')} AS cleaned FROM bronze_orders"
    ),
    "clean_amount": over(
        "bronze_orders", f"SELECT order_id, order_amount, {money('order_amount')} AS cleaned FROM bronze_orders"
    ),
    "parse_date_multi": over(
        "bronze_orders", f"SELECT order_id, order_date, {any_date('order_date')} AS cleaned FROM bronze_orders"
    ),
    "parse_ts_multi": over(
        "bronze_mixed_tickets",
        f"SELECT ticket_id, ticket_resolved, {multi_ts('ticket_resolved')} AS cleaned FROM bronze_mixed_tickets",
    ),
    "parse_ts_iso": over(
        "bronze_clickstream",
        f"SELECT event_id, timestamp, {iso_ts('timestamp')} AS cleaned FROM bronze_clickstream",
    ),
    "map_synonyms": over(
        "bronze_orders",
        f"""SELECT order_id, {spelled("status", STATUS)} AS as_null,
        coalesce({spelled("status", STATUS)}, status) AS as_raw,
        coalesce({spelled("status", STATUS)}, lower(trim(status))) AS as_normalized FROM bronze_orders""",
    ),
    "synonym_join": over(
        "bronze_customers",
        """SELECT customer_id, email, if(source = 'MACHINERY', source, source[1:3]) AS source
        FROM bronze_customers""",
    ),
    "standardize_status": over(
        "bronze_orders",
        f"""SELECT order_id, {spelled("status", STATUS)} AS cleaned,
        coalesce({spelled("status", STATUS_DRAFT)}, lower(trim(status))) AS draft FROM bronze_orders""",
    ),
    "standardize_payment": over(
        "bronze_orders",
        f"""SELECT order_id, {spelled("payment_method", PAYMENT)} AS cleaned,
        coalesce({spelled("payment_method", PAYMENT_DRAFT)}, lower(trim(payment_method))) AS draft
        FROM bronze_orders""",
    ),
    "silver_orders": table("silver_orders"),
    "silver_orders_draft": over(
        "bronze_orders",
        f"""SELECT order_id, customer_id, product_id, {quantity("quantity")} AS quantity,
        {money("order_amount")} AS order_amount, {any_date("order_date")} AS order_date,
        coalesce({spelled("status", STATUS_DRAFT)}, lower(trim(status))) AS status,
        coalesce({spelled("payment_method", PAYMENT_DRAFT)}, lower(trim(payment_method))) AS payment_method
        FROM bronze_orders""",
    ),
    "standardize_category": over(
        "bronze_products",
        f"""SELECT product_id, coalesce({spelled("category", CATEGORY)}, category) AS published,
        coalesce({spelled("category", CATEGORY_DRAFT)}, category) AS draft,
        {spelled("category", CATEGORY)} AS audit FROM bronze_products""",
    ),
    "silver_products": table("silver_products"),
    "standardize_issue": over(
        "bronze_tickets", f"SELECT ticket_id, {spelled('issue_type', ISSUE)} AS cleaned FROM bronze_tickets"
    ),
    "standardize_sentiment": over(
        "bronze_tickets", f"SELECT ticket_id, {spelled('sentiment', SENTIMENT)} AS cleaned FROM bronze_tickets"
    ),
    "clean_agent": over("silver_tickets", "SELECT ticket_id, support_agent AS cleaned FROM silver_tickets"),
    "impute_interval": over(
        "filled_tickets",
        "SELECT ticket_id, resolution_time_hours, ticket_created, ticket_resolved FROM filled_tickets",
    ),
    "silver_tickets": table("silver_tickets"),
    "valid_ticket_filter": over(
        "parsed_tickets",
        """SELECT * FROM parsed_tickets WHERE coalesce(ticket_created, ticket_resolved) IS NOT NULL
        AND coalesce(ticket_created <= ticket_resolved, true)""",
    ),
    "silver_clickstream": table("silver_clickstream"),
    "silver_clickstream_v1": over(
        "silver_clickstream",
        f"""SELECT s.* EXCLUDE (ingest_run_id, timestamp), {iso_ts("b.timestamp")} AS timestamp
        FROM silver_clickstream s JOIN bronze_clickstream b USING (event_id)""",
    ),
    # gold
    "surrogate_key": over(
        "bronze_orders",
        """SELECT row_number() OVER (ORDER BY order_amount NULLS FIRST, order_id) AS amount_key,
        order_amount, order_id FROM bronze_orders""",
    ),
    "dim_customer": table("dim_customer"),
    "dim_product": table("dim_product"),
    "dim_support_agent": table("dim_support_agent"),
    "dim_date": over(
        "span",
        """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
        monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, if(isodow(d) >= 6, 'Yes', 'No') AS is_weekend
        FROM (SELECT CAST(unnest(range(CAST(start_date AS TIMESTAMP), end_date + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
              AS d FROM span)""",
    ),
    "fact_orders": table("fact_orders"),
    "fact_orders_v1": over("fact_orders", "SELECT * EXCLUDE (status) FROM fact_orders"),
    "fact_orders_unknown_member": over(
        "fact_orders",
        """SELECT * REPLACE (ifnull(customer_key, -1) AS customer_key, ifnull(product_key, -1) AS product_key,
        ifnull(date_key, -1) AS date_key) FROM fact_orders""",
    ),
    "fact_orders_unique_products": over(
        "silver_orders",
        "dim_customer",
        "first_products",
        f"""SELECT order_id, customer_key, product_key, {day_key("order_date")} AS date_key, quantity, order_amount,
        payment_method, status FROM silver_orders
        LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)
        LEFT JOIN first_products USING (product_id)""",
    ),
    "fact_support_tickets": table("fact_support_tickets"),
    "fact_support_tickets_v1": over(
        "fact_support_tickets",
        """SELECT * EXCLUDE (created_time, resolved_time) REPLACE (
        if(created_time = TIME '00:00:00', created_date_key, NULL) AS created_date_key,
        if(resolved_time = TIME '00:00:00', resolved_date_key, NULL) AS resolved_date_key)
        FROM fact_support_tickets JOIN (
          SELECT ticket_id, CAST(ticket_created AS TIME) AS created_time, CAST(ticket_resolved AS TIME) AS resolved_time
          FROM silver_tickets) USING (ticket_id)""",
    ),
    "fact_clickstream": table("fact_clickstream"),
    "revenue_total": over(
        "sales",
        "SELECT CAST(sum(order_amount) FILTER (WHERE status = 'success') AS DECIMAL(20,2)) AS revenue FROM sales",
    ),
    "revenue_stats": over(
        "sales",
        """SELECT min(order_amount) AS min_amount, max(order_amount) AS max_amount,
        CAST(round(CAST(sum(order_amount) AS DOUBLE) / count(order_amount), 6) AS DECIMAL(14,6)) AS avg_amount
        FROM sales WHERE status = 'success'""",
    ),
    "top_orders": over(
        "fact_orders",
        f"""SELECT order_id, product_key, quantity, order_amount FROM fact_orders WHERE status = 'success'
        ORDER BY order_amount DESC NULLS LAST, {first("order_id", "product_key", "quantity")} LIMIT 100""",
    ),
    # measures
    "kpi_overview": over(
        "sold",
        """SELECT CAST(sum(order_amount) FILTER (WHERE status = 'success') AS DECIMAL(20,2)) AS revenue,
        count(*) AS orders, (SELECT count(*) FROM silver_customers) AS customers,
        CAST(sum(quantity) FILTER (WHERE status = 'success') AS BIGINT) AS products_sold,
        (SELECT count(*) FROM events) AS website_events FROM sold""",
    ),
    "revenue_trend": over(
        "sold",
        per_month(
            "CAST(sum(order_amount) AS DECIMAL(20,2)) AS revenue", "sold", "day", "status = 'success'"
        ),
    ),
    "order_trend": over("sold", per_month("count(*) AS orders", "sold", "day")),
    "revenue_by_category": over(
        "sold",
        "first_products",
        """SELECT category, CAST(sum(order_amount) AS DECIMAL(20,2)) AS revenue FROM sold
        LEFT JOIN first_products USING (product_id)
        WHERE status = 'success' GROUP BY category""",
    ),
    "customer_growth": over(
        "silver_customers",
        """SELECT CAST(m AS DATE) AS signup_month, n AS new_customers,
        CAST(sum(n) OVER (ORDER BY m) AS BIGINT) AS total_customers FROM (
          SELECT date_trunc('month', signup_date) AS m, count(*) AS n FROM silver_customers
          WHERE signup_date IS NOT NULL GROUP BY ALL)""",
    ),
    "avg_customer_spend": over(
        "spend",
        f"""SELECT CAST(r AS DECIMAL(20,2)) AS revenue, n AS customers,
        CAST(sign(r) * ((2 * CAST(abs(r) * 100 AS HUGEINT) + n) // (2 * n)) AS DOUBLE) / 100 AS avg_spend
        FROM (SELECT sum(spend) AS r, count(*) AS n FROM spend)""",
    ),
    "avg_orders_per_customer": over(
        "sold",
        f"""SELECT n AS orders, c AS customers, {pct("n", "c", 0)} / 100 AS avg_orders FROM
        (SELECT count(*) AS n, count(DISTINCT known_customer) AS c FROM sold WHERE known_customer IS NOT NULL)""",
    ),
    "revenue_distribution": over(
        "spend",
        """SELECT CAST(floor(spend / 500) * 500 AS BIGINT) AS band_start, count(*) AS customers
        FROM spend GROUP BY ALL""",
    ),
    "customer_segmentation": over(
        "spend",
        f"""SELECT CASE WHEN spend > 2000 THEN 'High' WHEN spend > 500 THEN 'Mid' ELSE 'Low' END AS segment,
        {SEGMENT_SUMS} FROM spend GROUP BY ALL""",
    ),
    "customer_quartile_segments": over(
        "spend",
        f"""SELECT CASE WHEN spend > q3 THEN 'High' WHEN spend > q1 THEN 'Mid' ELSE 'Low' END AS segment,
        {SEGMENT_SUMS} FROM spend, (
          SELECT min(spend) FILTER (WHERE 4 * place >= n) AS q1, min(spend) FILTER (WHERE 4 * place >= 3 * n) AS q3
          FROM (SELECT spend, row_number() OVER (ORDER BY spend) AS place, count(*) OVER () AS n FROM spend)
        ) GROUP BY ALL""",
    ),
    "website_activity": over(
        "silver_clickstream",
        f"""SELECT {day_key("CAST(timestamp AS DATE)")} AS date_key, event_type, count(*) AS events
        FROM silver_clickstream GROUP BY ALL""",
    ),
    "product_categories": over(
        "silver_products", "SELECT category, count(*) AS products FROM silver_products GROUP BY category"
    ),
    "resolution_rate": over(
        "silver_tickets",
        f"""SELECT count(*) AS tickets, count(ticket_resolved) AS resolved,
        {pct("count(ticket_resolved)", "count(*)")} AS resolution_rate FROM silver_tickets""",
    ),
    "resolution_rate_stated": over(
        "bronze_tickets",
        f"""SELECT count(*) AS tickets, count(ticket_resolved) AS resolved,
        {pct("count(ticket_resolved)", "count(*)")} AS resolution_rate FROM bronze_tickets""",
    ),
    "avg_resolution_time": over(
        "silver_tickets",
        """SELECT 'overall' AS scope, NULL AS issue_type, count(*) AS tickets, avg(resolution_time_hours) AS avg_hours
        FROM silver_tickets UNION ALL
        SELECT 'issue_type', issue_type, count(*), avg(resolution_time_hours) FROM silver_tickets GROUP BY issue_type""",
    ),
    "ticket_volume": over("silver_tickets", per_month("count(*) AS tickets", "silver_tickets", "ticket_created")),
    "support_agents": over(
        "silver_tickets",
        """SELECT support_agent, count(*) AS tickets, avg(resolution_time_hours) AS avg_hours
        FROM silver_tickets GROUP BY support_agent""",
    ),
    "customer_sentiment": over(
        "silver_tickets",
        f"""SELECT sentiment, n AS tickets, {pct("n", "CAST(sum(n) OVER () AS BIGINT)")} AS share_pct
        FROM (SELECT sentiment, count(*) AS n FROM silver_tickets GROUP BY sentiment)""",
    ),
    "issue_types": over(
        "silver_tickets", "SELECT issue_type, count(*) AS tickets FROM silver_tickets GROUP BY issue_type"
    ),
    # announced extensions
    "incremental_load": over(
        "bronze_customers",
        f"""SELECT * FROM bronze_customers b WHERE NOT EXISTS (
          SELECT 1 FROM bronze_customers m
          WHERE m.source = 'MACHINERY' AND m.customer_id IS NOT DISTINCT FROM b.customer_id)
        UNION ALL (SELECT DISTINCT ON (customer_id) * REPLACE (
          {titled("regexp_replace(first_name, '[0-9]', '', 'g')")} AS first_name) FROM bronze_customers
          WHERE source = 'MACHINERY' ORDER BY customer_id, {first(*CUSTOMER_REST)})""",
    ),
    "load_partitions": over(
        "bronze_orders",
        f"""SELECT if(again, 'again', status) AS status, if(again, 4, revision) AS revision,
        if(again AND order_id LIKE '%1', 'voucher', payment_method) AS payment_method,
        * EXCLUDE (status, revision, payment_method, again)
        FROM (SELECT *, revision <= 4 AND payment_method IN ('UPI', 'cash') AS again FROM (
          SELECT DISTINCT ON (order_id) *, CAST(length(order_amount) AS INTEGER) AS revision
          FROM bronze_orders ORDER BY order_id, {first(*ORDER_COLS.split()[1:])}))""",
    ),
    "quality_rules": over(
        "bronze_orders",
        " UNION ALL ".join(
            f"""SELECT '{name}' AS rule, n AS checked, bad AS failed, {pct("bad", "n")} AS failed_pct FROM (
            SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS bad FROM bronze_orders)"""
            for name, rule in ORDER_RULES.items()
        ),
    ),
    "quality_quarantine": over(
        "bronze_orders",
        "SELECT * FROM (SELECT *, concat_ws(',', "
        + ", ".join(f"if(coalesce({rule}, false), NULL, '{name}')" for name, rule in ORDER_RULES.items())
        + ") AS failed_rules FROM bronze_orders) WHERE failed_rules <> ''",
    ),
}
