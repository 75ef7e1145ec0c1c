"""Column functions: each takes a column (or its name) and returns a column."""

from crispstar.functions.numbers import as_number, clean_amount, clean_quantity, parse_number
from crispstar.functions.synonyms import (
    map_synonyms,
    standardize_category,
    standardize_issue,
    standardize_payment,
    standardize_sentiment,
    standardize_status,
    synonym_join,
)
from crispstar.functions.temporal import (
    hours_between,
    parse_date_multi,
    parse_ts_iso,
    parse_ts_lenient,
    parse_ts_multi,
    shift_hours,
)
from crispstar.functions.text import clean_agent, clean_person_name, clean_phone, is_blank, title_case

__all__ = [
    "as_number",
    "clean_agent",
    "clean_amount",
    "clean_person_name",
    "clean_phone",
    "clean_quantity",
    "hours_between",
    "is_blank",
    "map_synonyms",
    "parse_date_multi",
    "parse_number",
    "parse_ts_iso",
    "parse_ts_lenient",
    "parse_ts_multi",
    "shift_hours",
    "standardize_category",
    "standardize_issue",
    "standardize_payment",
    "standardize_sentiment",
    "standardize_status",
    "synonym_join",
    "title_case",
]
