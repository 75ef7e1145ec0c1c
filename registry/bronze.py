"""Dirty bronze tables derived from the driver's clean ones.

Each text is valid in Spark and in DuckDB, but for the repeated customers, and
gives the same rows in both; the Spark side fills the braces with DataFrames,
the check side with view names. Every row of the source tables is used; dirt is chosen by key, so that there is
no randomness. Order dates are moved by 20 years into the date dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCES = {
    "bronze_customers": ("customer",),
    "bronze_orders": ("orders",),
    "bronze_products": ("part",),
    "bronze_tickets": ("events",),
    "bronze_clickstream": ("events",),
    "bronze_mixed_tickets": ("events",),
}

BRONZE_SQL = {
    # All customers, and every twentieth a second time without an email.
    "bronze_customers": """
SELECT CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE concat('CUST-', lpad(CAST(c_custkey AS STRING), 10, '0')) END AS customer_id,
  CASE c_custkey % 4 WHEN 0 THEN ' al1ce ' WHEN 1 THEN 'BOB' WHEN 2 THEN 'c4rol ann' ELSE NULL END AS first_name,
  CASE c_custkey % 3 WHEN 0 THEN 'SM1TH' WHEN 1 THEN ' o''neil' ELSE 'de la 2cruz' END AS last_name,
  CASE WHEN copy_no = 1 OR c_custkey % 9 = 0 THEN NULL ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS email,
  CASE c_custkey % 4 WHEN 0 THEN concat('001-555-', lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0'), 'x12')
    WHEN 1 THEN concat('+1-555-', lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0'))
    WHEN 2 THEN concat(' 555.', lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0'))
    ELSE lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') END AS phone_number,
  CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'm' END AS gender,
  CASE WHEN c_custkey % 50 = 0 THEN DATE '2024-05-01' ELSE DATE '1980-02-03' END AS dob,
  CASE WHEN c_custkey % 60 = 1 THEN DATE '2030-01-01' WHEN c_custkey % 71 = 5 THEN NULL
    ELSE CAST(concat('20', CAST(15 + c_custkey % 8 AS STRING), '-0', CAST(1 + c_custkey % 9 AS STRING), '-15') AS DATE) END AS signup_date,
  concat(CAST(c_custkey AS STRING), ' Main St') AS address, concat('City', CAST(c_nationkey AS STRING)) AS city,
  CAST(NULL AS STRING) AS state, concat('N', CAST(c_nationkey AS STRING)) AS country,
  concat('DEV-', CAST(c_custkey % 70 AS STRING)) AS device_id_s, c_mktsegment AS source
FROM (SELECT c_custkey, c_nationkey, c_mktsegment, {copies} AS copy_no FROM {customer}) c
""",
    # Every fiftieth order repeats the id of the order before it. The product
    # follows the customer, so products grow with the data; some orders have none.
    "bronze_orders": """
SELECT concat('ORD-', lpad(CAST(CASE WHEN o_orderkey % 50 = 7 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING), 12, '0')) AS order_id,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('CUST-', lpad(CAST(o_custkey AS STRING), 10, '0')) END AS customer_id,
  CASE WHEN o_orderkey % 89 = 3 THEN NULL ELSE concat('PROD-', lpad(CAST(o_custkey + o_orderkey % 5 AS STRING), 10, '0')) END AS product_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'five' WHEN 1 THEN '2.0' WHEN 2 THEN '' WHEN 3 THEN '-3' WHEN 4 THEN ' Five ' WHEN 5 THEN 'n/a' ELSE CAST(o_orderkey % 9 + 1 AS STRING) END AS quantity,
  CASE o_orderkey % 10 WHEN 0 THEN concat('-', CAST(o_orderkey % 13 AS STRING), '.25') WHEN 1 THEN concat('1,', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '.50')
    WHEN 2 THEN 'N/A' WHEN 3 THEN '-50' ELSE concat(CAST(o_orderkey % 13 AS STRING), '.25') END AS order_amount,
  CASE o_orderkey % 5 WHEN 0 THEN concat(d, 'T08:30:00.000000') WHEN 1 THEN concat(substr(d, 9, 2), '-', substr(d, 6, 2), '-', substr(d, 1, 4))
    WHEN 2 THEN 'bad-date' WHEN 3 THEN concat('1999', substr(d, 5, 6)) ELSE d END AS order_date,
  CASE o_orderkey % 7 WHEN 0 THEN 'success' WHEN 1 THEN ' SUC' WHEN 2 THEN 'Fail ' WHEN 3 THEN 'failed' WHEN 4 THEN 'REF' WHEN 5 THEN ' refunded' ELSE 'zzz' END AS status,
  CASE o_orderkey % 9 WHEN 0 THEN 'card' WHEN 1 THEN 'CRAD' WHEN 2 THEN 'c@rd' WHEN 3 THEN 'cd ' WHEN 4 THEN 'Wall-et' WHEN 5 THEN 'wallet' WHEN 6 THEN 'UPI' WHEN 7 THEN 'cash' ELSE 'iou' END AS payment_method
FROM (SELECT o_orderkey, o_custkey, substr(CAST(o_orderdate + INTERVAL 20 YEAR AS STRING), 1, 10) AS d FROM {orders}) o
""",
    # All parts; every fortieth takes the id of the part before it, so its own
    # id is missing from the dimension.
    "bronze_products": """
SELECT concat('PROD-', lpad(CAST(CASE WHEN p_partkey % 40 = 39 THEN p_partkey - 1 ELSE p_partkey END AS STRING), 10, '0')) AS product_id,
  concat(' ', p_name, ' ') AS product_name,
  CASE p_partkey % 10 WHEN 0 THEN 'CLO' WHEN 1 THEN '3l3ctronics' WHEN 2 THEN ' aut' WHEN 3 THEN 'hom3' WHEN 4 THEN 'kitchen_' WHEN 5 THEN 'Toys-' WHEN 6 THEN 'b3auty' WHEN 7 THEN 'sports_' WHEN 8 THEN NULL ELSE 'Home' END AS category,
  CASE p_partkey % 6 WHEN 0 THEN '-100' WHEN 1 THEN '1,250.5' WHEN 2 THEN '0' WHEN 3 THEN 'free' ELSE concat(CAST(p_partkey % 300 AS STRING), '.99') END AS price
FROM {part} p
""",
    "bronze_tickets": """
SELECT concat('TKT-', CAST(event_id AS STRING)) AS ticket_id, concat('CUST-', lpad(CAST(user_id AS STRING), 10, '0')) AS customer_id,
  CASE event_id % 6 WHEN 0 THEN 'tcudorp' WHEN 1 THEN 'PAY' WHEN 2 THEN 'd3lay' WHEN 3 THEN ' Refundx' WHEN 4 THEN 'other' ELSE NULL END AS issue_type,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE replace(t, ' ', 'T') END AS ticket_created,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '2023-12-31 00:00:00' WHEN event_id % 5 = 0 THEN t ELSE concat('2024-02-10 ', substr(t, 12, 8)) END AS ticket_resolved,
  CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 17 = 0 THEN CAST(-4 AS DOUBLE)
    ELSE CAST(event_id % 72 AS DOUBLE) + CASE WHEN event_id % 4 = 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS resolution_time_hours,
  CASE event_id % 4 WHEN 0 THEN 'pos' WHEN 1 THEN 'N3gativ3' WHEN 2 THEN ' neutral' ELSE '?' END AS sentiment,
  CASE event_id % 4 WHEN 0 THEN 'agent_07 smith' WHEN 1 THEN 'JANE  doe9' WHEN 2 THEN '42' ELSE NULL END AS support_agent
FROM (SELECT event_id, user_id, substr(CAST(ts AS STRING), 1, 19) AS t FROM {events}) e
""",
    "bronze_clickstream": """
SELECT concat('EVT-', CAST(event_id AS STRING)) AS event_id, concat('SES-', CAST(user_id % 50 AS STRING)) AS session_id,
  concat('CUST-', lpad(CAST(user_id AS STRING), 10, '0')) AS customer_id, concat(' ', upper(event_type)) AS event_type,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ' ' ELSE concat('/p/', CAST(event_id % 40 AS STRING), ' ') END AS page_url,
  concat(' DEV-', CAST(user_id % 70 AS STRING)) AS device_id,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN replace(t, ' ', 'T') WHEN 2 THEN concat(t, '.250') ELSE t END AS timestamp,
  concat('run-', CAST(event_id % 3 AS STRING)) AS ingest_run_id
FROM (SELECT event_id, user_id, event_type, substr(CAST(ts AS STRING), 1, 19) AS t FROM {events}) e
""",
    # Tickets of three hours and some minutes, in three layouts and in none.
    "bronze_mixed_tickets": """
SELECT concat('TKT-', CAST(event_id AS STRING)) AS ticket_id,
  CASE event_id % 4 WHEN 0 THEN concat(c, ':00') WHEN 1 THEN concat(substr(c, 6, 2), '/', substr(c, 9, 2), '/', substr(c, 1, 4), substr(c, 11, 6))
    WHEN 2 THEN concat(substr(c, 9, 2), '-', substr(c, 6, 2), '-', substr(c, 1, 4), substr(c, 11, 6)) ELSE 'soon' END AS ticket_created,
  CASE WHEN event_id % 19 = 0 THEN 'n/a' WHEN event_id % 3 = 0 THEN concat(r, ':00') WHEN event_id % 3 = 1 THEN concat(substr(r, 6, 2), '/', substr(r, 9, 2), '/', substr(r, 1, 4), substr(r, 11, 6))
    ELSE concat(substr(r, 9, 2), '-', substr(r, 6, 2), '-', substr(r, 1, 4), substr(r, 11, 6)) END AS ticket_resolved,
  CASE event_id % 7 WHEN 0 THEN CAST(3.37 AS DOUBLE) WHEN 1 THEN NULL ELSE CAST(3.25 AS DOUBLE) END AS resolution_time_hours
FROM (SELECT event_id, substr(CAST(ts AS STRING), 1, 16) AS c, substr(CAST(ts + INTERVAL '195' MINUTE AS STRING), 1, 16) AS r FROM {events}) e
""",
}


# Copy numbers 0, or 0 and 1 for every twentieth customer, one row each.
LAST_COPY = "CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END"
SPARK_COPIES = f"explode(sequence(0, {LAST_COPY}))"
CHECK_COPIES = f"unnest(range(0, 1 + {LAST_COPY}))"


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bronze table over the driver's Parquet files."""
    sources = {s: spark.read.parquet(f"{sf_dir}/{s}.parquet") for s in SOURCES[name]}
    return spark.sql(BRONZE_SQL[name].replace("{copies}", SPARK_COPIES), **sources)


def bronze_check_sql(name: str) -> str:
    """The same table as text over the driver's views."""
    views = {s: s for s in SOURCES[name]}
    return BRONZE_SQL[name].format(copies=CHECK_COPIES, **views).strip()
