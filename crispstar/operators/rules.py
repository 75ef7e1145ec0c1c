"""Rules across columns: patterns, dates, durations, expected amounts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.functions.numbers import as_number, parse_number
from crispstar.functions.temporal import hours_between, parse_ts_iso, parse_ts_lenient
from crispstar.operators.columns import percent

DIGIT = "[0-9]"


def regex_violations(df: DataFrame, cols: Sequence[str], pattern: str = DIGIT) -> DataFrame:
    """Rows where any of the columns matches the pattern."""
    return df.filter(reduce(or_, [F.col(c).rlike(pattern) for c in cols]))


def date_order_violations(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose ``earlier`` date lies after the ``later`` one."""
    return df.filter(F.col(earlier) > F.col(later))


def future_dates(df: DataFrame, cols: Sequence[str], as_of: Column | None = None, parser=None) -> DataFrame:
    """Rows where any of the columns lies after ``as_of``.

    Without it, dates are compared with today and timestamps with the present
    moment, as the wall clock of the session shows it where they carry no zone.
    ``parser`` turns text columns into timestamps first.
    """
    read = parser or F.col
    now = {"date": F.current_date(), "timestamp_ntz": F.localtimestamp()}
    kinds = [f.dataType.simpleString() for f in df.select(*[read(c) for c in cols]).schema]
    limits = [now.get(k, F.current_timestamp()) if as_of is None else as_of for k in kinds]
    return df.filter(reduce(or_, [read(c) > limit for c, limit in zip(cols, limits)]))


def inverted_intervals(
    df: DataFrame, start: str, end: str, parse: Callable[[str], Column] | bool = True
) -> DataFrame:
    """Rows that end before they start.

    Text is read leniently by default; another parser may be given, and
    ``parse=False`` compares the columns as they are.
    """
    read = parse if callable(parse) else (parse_ts_lenient if parse else F.col)
    return df.filter(read(start) > read(end))


def duration_hours(
    df: DataFrame,
    start: str = "ticket_created",
    end: str = "ticket_resolved",
    parser: Callable[[str], Column] = parse_ts_lenient,
) -> DataFrame:
    """Rows with both ends set, and the hours between them as ``calculated_hours``."""
    both = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    return both.withColumn("calculated_hours", hours_between(parser(start), parser(end)))


def _ordered(df: DataFrame, start: str, end: str, parser: Callable[[str], Column]) -> DataFrame:
    """Rows with both ends parsed and in order, with the calculated hours."""
    parsed = df.withColumns({"_start": parser(start), "_end": parser(end)})
    forward = parsed.filter(F.col("_start") <= F.col("_end"))
    return forward.withColumn("calculated_hours", hours_between("_start", "_end"))


def duration_reconcile(
    df: DataFrame,
    hours: str = "resolution_time_hours",
    start: str = "ticket_created",
    end: str = "ticket_resolved",
    parser: Callable[[str], Column] = parse_ts_iso,
) -> DataFrame:
    """Intervals checked, and how many agree or disagree with the stated hours, in one pass."""
    calculated, stated = F.col("calculated_hours"), F.round(F.col(hours), 2)
    return _ordered(df, start, end, parser).agg(
        F.count("*").alias("total_checked"),
        F.count_if(calculated == stated).alias("matched"),
        F.count_if(calculated != stated).alias("mismatched"),
    )


def duration_mismatches(
    df: DataFrame,
    hours: str = "resolution_time_hours",
    start: str = "ticket_created",
    end: str = "ticket_resolved",
    parser: Callable[[str], Column] = parse_ts_lenient,
) -> DataFrame:
    """The rows whose stated hours disagree with their interval."""
    rows = _ordered(df, start, end, parser).drop("_start", "_end")
    return rows.filter(F.col("calculated_hours") != F.round(F.col(hours), 2))


def expected_amount(orders: DataFrame, products: DataFrame, product_id: str | None = None) -> DataFrame:
    """Unit price times quantity beside the stated amount, for one product or all.

    The price list is joined by its two needed columns. Catalyst broadcasts it
    while its files are below the threshold; beyond that both sides are plain
    exchanges, which AQE splits when a product is hot.
    """
    wanted = orders if product_id is None else orders.filter(F.col("product_id") == product_id)
    unit_price, qty = as_number("price"), parse_number("quantity", "int")
    joined = wanted.join(products.select("product_id", "price"), "product_id")
    return joined.select(
        "order_id",
        "product_id",
        "quantity",
        "price",
        "order_amount",
        unit_price.alias("unit_price"),
        qty.alias("qty"),
        (unit_price * qty).alias("expected_amount"),
    )


def date_span(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """First and last date over several columns of several tables.

    Each table is reduced to one row before the union, one pass per table even
    when several of its columns take part.
    """
    per_table: dict[int, tuple[DataFrame, list[str]]] = {}
    for df, col in sources:
        per_table.setdefault(id(df), (df, []))[1].append(col)
    ends = []
    for df, cols in per_table.values():
        days = [F.col(c).cast("date") for c in cols]
        lows, highs = [F.min(d) for d in days], [F.max(d) for d in days]
        ends.append(df.agg(_extreme(F.least, lows).alias("lo"), _extreme(F.greatest, highs).alias("hi")))
    return reduce(DataFrame.unionByName, ends).agg(
        F.min("lo").alias("start_date"), F.max("hi").alias("end_date")
    )


def _extreme(pick, columns: list[Column]) -> Column:
    return pick(*columns) if len(columns) > 1 else columns[0]


def quality_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per named rule: rows checked, rows that fail, percentage.

    A rule is the condition a good row meets; a condition that is NULL fails.
    All rules share one pass over the table.
    """
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()],
    )
    lines = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed")) for n in rules])
    from_totals = totals.select(F.col("_rows").alias("checked"), F.inline(lines))
    pct = percent(F.col("failed"), F.col("checked"))
    return from_totals.select("rule", "checked", "failed", pct.alias("failed_pct"))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that fail any rule, with the names of the rules they fail."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken))).filter(F.size("failed_rules") > 0)
