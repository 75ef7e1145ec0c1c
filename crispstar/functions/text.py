"""Names, agents and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crispstar.functions.columns import as_column

# Fixed values.
DIGITS = "0123456789"
NOT_LETTER_OR_BLANK = "[^A-Za-z ]"
EXTENSION_OR_NON_DIGIT = "x.*$|[^0-9]"
PREFIX_BEFORE_TEN_DIGITS = "^(001|1)(?=[0-9]{10}$)"


def title_case(col: Column | str) -> Column:
    """Outer blanks off, first letter of every word upper case, the rest lower case."""
    return F.initcap(F.trim(as_column(col)))


def clean_person_name(col: Column | str) -> Column:
    """Drop digits, then title-case. Double blanks inside a name stay."""
    return title_case(F.translate(as_column(col), DIGITS, ""))


def clean_agent(col: Column | str) -> Column:
    """Keep letters and blanks, then title-case. A name made of digits becomes ``''``, not NULL."""
    return title_case(F.regexp_replace(as_column(col), NOT_LETTER_OR_BLANK, ""))


def phone_digits(col: Column | str) -> Column:
    """Drop everything from the first lower-case ``x`` on, then every other non-digit."""
    return F.regexp_replace(as_column(col), EXTENSION_OR_NON_DIGIT, "")


def drop_phone_prefix(col: Column | str) -> Column:
    """Drop a ``001`` or ``1`` country prefix that stands before exactly ten digits."""
    return F.regexp_replace(as_column(col), PREFIX_BEFORE_TEN_DIGITS, "")


def clean_phone(col: Column | str) -> Column:
    """Digits of the number itself, without extension and country prefix."""
    return drop_phone_prefix(phone_digits(col))


def is_blank(col: Column | str) -> Column:
    """NULL, empty or blanks only. The cast lets the test take a column of any type."""
    c = as_column(col)
    return c.isNull() | (F.trim(c.cast("string")) == "")
