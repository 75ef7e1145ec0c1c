"""DuckDB statements for the queries over time."""

from __future__ import annotations

from registry.checks import over

_LATEST = """(SELECT DISTINCT ON (customer_id, ticket_created) * FROM silver_tickets WHERE ticket_created IS NOT NULL
    ORDER BY customer_id, ticket_created, ticket_id DESC)"""
_AFTER = over(
    "silver_clickstream",
    "silver_tickets",
    """SELECT e.event_id, e.customer_id, e.timestamp, t.ticket_id, t.ticket_created
    FROM (SELECT * FROM silver_clickstream WHERE timestamp IS NOT NULL) e LEFT JOIN silver_tickets t
    ON t.customer_id = e.customer_id AND t.ticket_created BETWEEN e.timestamp AND e.timestamp + INTERVAL 1 HOUR""",
)
_SESSIONS = over(
    "silver_clickstream",
    """SELECT customer_id, min(timestamp) AS session_start, max(timestamp) AS session_end, count(*) AS events FROM (
      SELECT customer_id, timestamp, sum(CASE WHEN timestamp <= before + INTERVAL 6 HOUR THEN 0 ELSE 1 END)
        OVER (PARTITION BY customer_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT customer_id, timestamp, lag(timestamp) OVER (PARTITION BY customer_id ORDER BY timestamp) AS before
        FROM silver_clickstream WHERE timestamp IS NOT NULL AND customer_id IS NOT NULL))
    GROUP BY customer_id, session""",
)

CHECKS: dict[str, str] = {
    "as_of_ticket": over(
        "silver_clickstream",
        "silver_tickets",
        f"""SELECT e.event_id, e.customer_id, e.timestamp, t.ticket_id, t.issue_type, t.ticket_created
        FROM silver_clickstream e ASOF LEFT JOIN {_LATEST} t
        ON e.customer_id = t.customer_id AND e.timestamp >= t.ticket_created""",
    ),
    "as_of_ticket_of_the_day": over(
        "silver_clickstream",
        "silver_tickets",
        f"""SELECT event_id, customer_id, timestamp, if(near, ticket_id, NULL) AS ticket_id,
        if(near, issue_type, NULL) AS issue_type, if(near, ticket_created, NULL) AS ticket_created FROM (
          SELECT e.event_id, e.customer_id, e.timestamp, t.ticket_id, t.issue_type, t.ticket_created,
            t.ticket_created >= e.timestamp - INTERVAL 1 DAY AS near
          FROM silver_clickstream e ASOF LEFT JOIN {_LATEST} t
          ON e.customer_id = t.customer_id AND e.timestamp > t.ticket_created)""",
    ),
    "events_during_tickets": over(
        "silver_clickstream",
        "silver_tickets",
        """SELECT e.event_id, e.customer_id, e.timestamp, t.ticket_id, t.ticket_created, t.ticket_resolved
        FROM silver_clickstream e JOIN silver_tickets t ON e.customer_id = t.customer_id
        AND e.timestamp >= t.ticket_created AND (e.timestamp <= t.ticket_resolved OR t.ticket_resolved IS NULL)""",
    ),
    "tickets_after_clicks": _AFTER,
    "stream_tickets_after_clicks": _AFTER,
    "customer_sessions": _SESSIONS,
    "stream_sessions": _SESSIONS,
    "status_history": over(
        "silver_orders",
        """, numbered AS (
          SELECT *, row_number() OVER w AS n, lag(status) OVER w AS status_before, lag(payment_method) OVER w AS method_before
          FROM silver_orders WINDOW w AS (PARTITION BY order_id ORDER BY order_date NULLS FIRST, status NULLS FIRST,
            payment_method NULLS FIRST, order_amount NULLS FIRST)),
        runs AS (
          SELECT *, sum(CASE WHEN n > 1 AND status IS NOT DISTINCT FROM status_before
            AND payment_method IS NOT DISTINCT FROM method_before THEN 0 ELSE 1 END)
            OVER (PARTITION BY order_id ORDER BY n ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM numbered),
        spans AS (
          SELECT order_id, run, first(status ORDER BY n) AS status, first(payment_method ORDER BY n) AS payment_method,
            first(order_date ORDER BY n) AS valid_from, count(*) AS rows FROM runs GROUP BY order_id, run)
        SELECT *, lead(valid_from) OVER (PARTITION BY order_id ORDER BY run) AS valid_to FROM spans""",
    ),
    "stream_clickstream": over(
        "silver_clickstream",
        """SELECT date_trunc('day', timestamp) AS window_start, event_type, count(DISTINCT event_id) AS events
        FROM silver_clickstream WHERE timestamp IS NOT NULL GROUP BY ALL""",
    ),
    "stream_window_counts": over(
        "silver_clickstream",
        """, arrived AS (
          SELECT *, event_id LIKE '%97' AND timestamp <= (SELECT max(timestamp) FILTER (WHERE event_id NOT LIKE '%97') FROM silver_clickstream)
            - INTERVAL 1 DAY AS late FROM silver_clickstream)
        SELECT date_trunc('day', timestamp) AS window_start, event_type, count(DISTINCT event_id) AS events, 'closed' AS kind
        FROM arrived WHERE timestamp IS NOT NULL AND NOT late GROUP BY ALL
        UNION ALL SELECT NULL, event_type, count(*), 'undated' FROM arrived WHERE timestamp IS NULL GROUP BY ALL
        UNION ALL SELECT NULL, NULL, count(*), 'late' FROM arrived WHERE late""",
    ),
}
