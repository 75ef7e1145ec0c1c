"""Dates and timestamps held as text in several layouts.

All timestamps come back without a zone. Text is read as wall clock time of the
session zone, which ``session.prepare`` fixes to UTC.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from crispstar.functions.columns import as_column

# The accepted layouts, first match wins.
DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd", "dd-MM-yyyy")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "dd-MM-yyyy HH:mm")
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")

_FIELDS = re.compile(r"'[^']*'|[A-Za-z]+|[^A-Za-z']+")
_CASTABLE = re.compile(r"yyyy-MM-dd(('T'| )HH:mm:ss(\.S{1,6})?)?")


def _fits(c: Column, fmt: str) -> Column:
    """Whether the text has the length and the shape a numeric datetime pattern can accept.

    A formatter throws and catches an exception for every text it refuses;
    testing first keeps that off the path of the many rows that have another
    layout. The length alone rules most of them out.
    """
    shape, shortest, longest = "", 0, 0
    for field in _FIELDS.findall(fmt):
        if field[0] == "S":
            low, high, part = 1, len(field), f"[0-9]{{1,{len(field)}}}"
        elif field[0].isalpha():
            low = high = len(field)
            part = f"[0-9]{{{len(field)}}}"
        else:
            literal = field.strip("'")
            low = high = len(literal)
            part = re.escape(literal)
        shape, shortest, longest = shape + part, shortest + low, longest + high
    return F.length(c).between(shortest, longest) & c.rlike(f"^{shape}$")


def _parse(c: Column, fmt: str) -> Column:
    """Timestamp of a text in one layout, else NULL.

    Text that has an ISO layout is cast, which is several times faster than a
    formatter and gives the same.
    """
    castable = _CASTABLE.fullmatch(fmt)
    parsed = c.try_cast("timestamp_ntz") if castable else F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return F.when(_fits(c, fmt), parsed)


def parse_ts_multi(col: Column | str, formats=TIMESTAMP_FORMATS) -> Column:
    """Timestamp by the first layout that fits, else NULL."""
    c = as_column(col)
    return F.coalesce(*[_parse(c, f) for f in formats])


def parse_date_multi(col: Column | str, formats=DATE_FORMATS) -> Column:
    """Date by the first layout that fits, else NULL."""
    return parse_ts_multi(col, formats).cast("date")


def parse_ts_iso(col: Column | str) -> Column:
    """Whole-second ISO timestamp with ``T`` or blank between date and time, else NULL.

    Fractional seconds are refused.
    """
    return parse_ts_multi(col, ISO_FORMATS)


def parse_ts_lenient(col: Column | str) -> Column:
    """Anything Spark itself reads as a timestamp: ``T``, fractions, date only; else NULL."""
    c = as_column(col)
    return F.when(c.rlike("[0-9]"), c.try_cast("timestamp")).cast("timestamp_ntz")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hours from start to end, rounded to two places."""
    seconds = F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))
    return F.round(seconds / 3600, 2)


def shift_hours(ts: Column | str, hours: Column | str, sign: int = 1) -> Column:
    """Move a timestamp by the whole part of ``hours`` (cut toward zero)."""
    whole = as_column(hours).try_cast("int")
    return F.timestamp_add("HOUR", whole * F.lit(sign), as_column(ts))
