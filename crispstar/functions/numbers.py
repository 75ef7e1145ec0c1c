"""Quantities, amounts and prices held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crispstar.functions.columns import as_column

# Spellings of a quantity that no cast understands, and the one
# number that stands for "unknown". Other negatives are kept.
QUANTITY_SPELLINGS = {"five": 5, "2.0": 2}
UNKNOWN_QUANTITY = -3
MONEY = "decimal(10,2)"


# What a text must look like at the least before a cast can read it: sign and
# digits between blanks or control characters for whole numbers; a digit of any
# script, or a name such as NaN, for the rest, with or without commas in it. A
# try_cast throws and catches an exception for every text it refuses; the test
# keeps the plainly bad texts away from it and never changes a result.
WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
FRACTION = r"\p{Nd}|(?i:n,*a,*n|i,*n,*f)"
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def parse_number(col: Column | str, type_name: str = "double") -> Column:
    """The text as a number of the given type; text that is not one is NULL."""
    c = as_column(col)
    return F.when(c.rlike(WHOLE if type_name in WHOLE_TYPES else FRACTION), c.try_cast(type_name))


def as_number(col: Column | str, type_name: str = "double") -> Column:
    """Number with a fraction from text with thousands commas, NULL when it does not parse."""
    c = as_column(col)
    return F.when(c.rlike(FRACTION), F.replace(c, F.lit(","), F.lit("")).try_cast(type_name))


def clean_quantity(col: Column | str) -> Column:
    """Known spellings first, then an integer; the unknown marker and the rest are NULL."""
    c = as_column(col)
    spellings = F.create_map(*[F.lit(x) for pair in QUANTITY_SPELLINGS.items() for x in pair])
    spelled = F.try_element_at(spellings, F.lower(F.trim(c)))
    return F.coalesce(spelled, F.nullif(parse_number(c, "int"), F.lit(UNKNOWN_QUANTITY)))


def clean_amount(col: Column | str) -> Column:
    """Two-place decimal, rounded half up; text and amounts above eight digits are NULL."""
    return as_number(col, MONEY)
