"""Column lists of the bronze tables.

Every dirty column is read as text, so that one bad value cannot change the
type of a column.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType


def _schema(text: str, **typed) -> StructType:
    return StructType([StructField(c, typed.get(c, StringType())) for c in text.split()])


CUSTOMERS = _schema(
    "customer_id first_name last_name email phone_number gender dob signup_date"
    " address city state country device_id_s source",
    dob=DateType(),
    signup_date=DateType(),
)
ORDERS = _schema("order_id customer_id product_id quantity order_amount order_date status payment_method")
PRODUCTS = _schema("product_id product_name category price")
TICKETS = _schema(
    "ticket_id customer_id issue_type ticket_created ticket_resolved resolution_time_hours"
    " sentiment support_agent",
    resolution_time_hours=DoubleType(),
)
CLICKSTREAM = _schema(
    "event_id session_id customer_id event_type page_url device_id timestamp ingest_run_id"
)
