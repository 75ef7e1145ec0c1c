"""DuckDB statements for the queries over sketches, subtotals, differences, lists and co-located tables."""

from __future__ import annotations

from registry.checks import over, short_phone

_SALES = """(SELECT o.*, p.category, CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS month
    FROM silver_orders o LEFT JOIN first_products p USING (product_id) WHERE status = 'success')"""
_METHODS = ("card", "wallet", "upi", "cash")
_NAMED = "concat_ws(',', " + ", ".join(f"CASE WHEN grouping({c}) = 0 THEN '{c}' END" for c in ("month", "category", "payment_method")) + ")"


def _not_listed(condition: str) -> str:
    return over("bronze_orders", "bronze_customers", f"SELECT order_id, customer_id FROM bronze_orders o WHERE {condition}")


_MACHINERY = "SELECT customer_id FROM bronze_customers WHERE source = 'MACHINERY'"
_SIDES = f"""old AS (SELECT customer_id, phone_number, city FROM silver_customers),
    new AS (SELECT o.* FROM (SELECT customer_id, {short_phone("phone_number")} AS phone_number, city FROM old) o,
      LATERAL (SELECT unnest(range(0, CASE WHEN customer_id LIKE '%77' THEN 2 ELSE 1 END)))
      WHERE customer_id NOT LIKE '%3' OR customer_id IS NULL)"""

CHECKS: dict[str, str] = {
    "customers_per_month_sketched": over(
        "silver_clickstream",
        """SELECT CAST(year(timestamp) * 100 + month(timestamp) AS INTEGER) AS month, count(DISTINCT customer_id) AS customers,
        true AS near, true AS same_in_one_pass FROM silver_clickstream WHERE timestamp IS NOT NULL GROUP BY ALL""",
    ),
    "resolution_percentiles": over(
        "silver_tickets",
        """SELECT support_agent, quantile_cont(resolution_time_hours, 0.5) AS p50, quantile_cont(resolution_time_hours, 0.95) AS p95,
        true AS p50_near, true AS p95_near FROM silver_tickets WHERE resolution_time_hours IS NOT NULL AND support_agent IS NOT NULL GROUP BY ALL""",
    ),
    "revenue_cube": over(
        "silver_orders",
        "first_products",
        f"""SELECT month, category, payment_method, {_NAMED} AS grouped_by, CAST(sum(order_amount) AS DECIMAL(20,2)) AS revenue,
        count(*) AS orders FROM {_SALES} GROUP BY CUBE (month, category, payment_method)""",
    ),
    "revenue_pivot": over(
        "silver_orders",
        "first_products",
        "SELECT month, "
        + ", ".join(f"CAST(sum(order_amount) FILTER (WHERE payment_method = '{m}') AS DECIMAL(20,2)) AS {m}" for m in _METHODS)
        + f" FROM {_SALES} GROUP BY month",
    ),
    "customer_changes": over(
        "silver_customers",
        f""", {_SIDES},
        found AS (SELECT *, 'removed' AS side FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
          UNION ALL SELECT *, 'added' FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)),
        counted AS (SELECT customer_id, phone_number, city, side, count(*) AS copies FROM found GROUP BY ALL)
        SELECT customer_id, phone_number, city, copies, CASE WHEN (SELECT count(DISTINCT f.side) FROM found f
          WHERE f.customer_id IS NOT DISTINCT FROM c.customer_id) = 2 THEN if(side = 'added', 'changed to', 'changed from') ELSE side END AS change
        FROM counted c""",
    ),
    "orders_not_in_counts": over(
        "bronze_orders",
        "bronze_customers",
        f"""SELECT 'not in' AS form, count(*) AS orders FROM bronze_orders WHERE customer_id NOT IN ({_MACHINERY})
        UNION ALL SELECT 'not in, known', count(*) FROM bronze_orders WHERE customer_id NOT IN ({_MACHINERY} AND customer_id IS NOT NULL)
        UNION ALL SELECT 'not in, empty', count(*) FROM bronze_orders WHERE customer_id NOT IN ({_MACHINERY} AND false)
        UNION ALL SELECT 'not exists', count(*) FROM bronze_orders o WHERE NOT EXISTS ({_MACHINERY} AND customer_id = o.customer_id)""",
    ),
    "orders_not_in_known_list": _not_listed(f"customer_id NOT IN ({_MACHINERY} AND customer_id IS NOT NULL)"),
    "orders_without_listed_customer": _not_listed(
        "NOT EXISTS (SELECT 1 FROM bronze_customers c WHERE c.source = 'MACHINERY' AND c.customer_id = o.customer_id)"
    ),
    "spend_of_bucketed_tables": over(
        "sold",
        """SELECT known_customer AS customer_id, CAST(sum(order_amount) AS DECIMAL(20,2)) AS revenue, count(*) AS orders
        FROM sold WHERE status = 'success' AND known_customer IS NOT NULL GROUP BY ALL""",
    ),
}
