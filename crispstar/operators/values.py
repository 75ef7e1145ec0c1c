"""Value frequencies, unparsable numbers, sentinels and signs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.functions.numbers import as_number, parse_number
from crispstar.operators.columns import by, percent, rest_of, sorted_by


def value_frequency(df: DataFrame, col: str, where: Column | None = None, by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first, or sorted by value from the top."""
    rows = df if where is None else df.filter(where)
    counted = rows.groupBy(col).agg(F.count("*").alias("cnt"))
    if by_value:
        return counted.orderBy(F.col(col).desc())
    return counted.orderBy(F.col("cnt").desc(), by(col))


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values; equal counts are settled by value."""
    return value_frequency(df, col).limit(n)


def unparsable_rate(df: DataFrame, col: str, type_name: str = "int") -> DataFrame:
    bad = F.count_if(parse_number(col, type_name).isNull())
    return df.agg(
        F.count("*").alias("total_rows"),
        bad.alias("unparsable_rows"),
        percent(bad, F.count("*")).alias("percentage"),
    )


def unparsable_values(df: DataFrame, col: str, type_name: str = "int") -> DataFrame:
    return value_frequency(df, col, where=parse_number(col, type_name).isNull())


def sentinel_rows(df: DataFrame, col: str, value: float) -> DataFrame:
    """Rows whose number, thousands commas aside, is the given marker."""
    return df.filter(as_number(col) == F.lit(float(value)))


def sentinel_by_group(df: DataFrame, col: str, value: float, group: str) -> DataFrame:
    return sentinel_rows(df, col, value).groupBy(group).agg(F.count("*").alias("cnt"))


def negative_count(df: DataFrame, col: str) -> DataFrame:
    return df.filter(as_number(col) < 0).agg(F.count("*").alias("negative_values"))


def negative_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


# The sign reports read the amount with a plain try_cast: text with a thousands
# comma does not parse and therefore has no sign.


def _amount(col: str) -> Column:
    return parse_number(col, "double")


def negative_by_group(df: DataFrame, amount: str, group: str) -> DataFrame:
    """Rows with a negative amount per group, most first."""
    counted = df.filter(_amount(amount) < 0).groupBy(group).agg(F.count("*").alias("negative_rows"))
    return counted.orderBy(F.col("negative_rows").desc(), by(group))


def negative_entities(df: DataFrame, amount: str, entity: str) -> DataFrame:
    return df.filter(_amount(amount) < 0).select(entity).distinct()


def negative_entity_pct(df: DataFrame, amount: str, entity: str) -> DataFrame:
    """Entities with a negative amount among all entities; rows without one form one entity.

    One flag per entity first, with partial aggregation, then one row.
    """
    flagged = df.groupBy(entity).agg(F.max(F.coalesce(_amount(amount) < 0, F.lit(False))).alias("negative"))
    negatives = F.count_if("negative")
    return flagged.agg(
        negatives.alias("negative_entities"),
        F.count("*").alias("total_entities"),
        percent(negatives, F.count("*")).alias("percentage"),
    )


def _seen(condition: Column) -> Column:
    """1 when the condition held for any row of the group, else 0."""
    return F.coalesce(F.max(condition), F.lit(False)).cast("int")


def sign_flags(df: DataFrame, amount: str, group: str) -> DataFrame:
    """Per group: has it a negative amount, has it a positive one. Zero and text set neither."""
    value = _amount(amount)
    return df.groupBy(group).agg(
        _seen(value < 0).alias("has_negative"), _seen(value > 0).alias("has_positive")
    )


def sign_flag_matrix(df: DataFrame, amount: str, group: str) -> DataFrame:
    flags = sign_flags(df, amount, group)
    return flags.groupBy("has_negative", "has_positive").agg(F.count("*").alias("cnt"))


def mixed_sign_groups(df: DataFrame, amount: str, group: str) -> DataFrame:
    both = (F.col("has_negative") == 1) & (F.col("has_positive") == 1)
    return sign_flags(df, amount, group).filter(both).orderBy(by(group))


def signed_counts(df: DataFrame, amount: str, group: str) -> DataFrame:
    """Per group: rows with a negative amount, and all others, which count as positive."""
    negative = F.count_if(_amount(amount) < 0)
    return df.groupBy(group).agg(
        negative.alias("negative_orders"), (F.count("*") - negative).alias("positive_orders")
    )


def sign_by_category(df: DataFrame, amount: str, group: str) -> DataFrame:
    """Rows per group and sign label; a missing or unparsable amount is labelled Positive."""
    label = F.when(_amount(amount) < 0, "Negative").otherwise("Positive")
    counted = df.groupBy(group, label.alias("amount_type")).agg(F.count("*").alias("orders"))
    return counted.orderBy(by(group), "amount_type")


def _by_magnitude(df: DataFrame, product: str, amount: str):
    value = _amount(amount)
    return df.groupBy(F.col(product), F.abs(value).alias("abs_amount")), value


def repeated_abs_amounts(df: DataFrame, product: str = "product_id", amount: str = "order_amount") -> DataFrame:
    """Amounts that a product shows more than once, the sign aside."""
    groups, _ = _by_magnitude(df, product, amount)
    repeated = groups.agg(F.count("*").alias("cnt")).filter("cnt > 1")
    return repeated.orderBy(by(product), by("abs_amount"))


def offset_pairs(
    df: DataFrame, product: str = "product_id", amount: str = "order_amount", largest_first: bool = False
) -> DataFrame:
    """Amounts that a product shows with both signs: candidates for a refund."""
    groups, value = _by_magnitude(df, product, amount)
    flags = groups.agg(_seen(value > 0).alias("has_positive"), _seen(value < 0).alias("has_negative"))
    both = flags.filter((F.col("has_positive") == 1) & (F.col("has_negative") == 1))
    size = F.col("abs_amount").desc() if largest_first else F.col("abs_amount").asc()
    return both.orderBy(by(product), size)


def value_lookup(df: DataFrame, col: str, values: list[str], order_by: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose trimmed value is in the list, optionally sorted."""
    found = df.filter(F.trim(F.col(col)).isin(*values))
    return sorted_by(found, *[by(c) for c in order_by], named=order_by) if order_by else found


def sorted_scan(df: DataFrame, col: str) -> DataFrame:
    """The whole table in the order of one column; the other columns settle ties.

    Give it a table as it is stored.
    """
    return sorted_by(df, by(col), named=(col,))


def random_group(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """One group picked at random, with its row count; the same seed picks the same group.

    NULL is a group of its own and is drawn like an empty text.
    """
    counted = df.groupBy(key).agg(F.count("*").alias("orders_count"))
    draw = F.md5(F.concat_ws("#", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))
    return counted.orderBy(draw, by(key)).limit(1)


def fractional_values(df: DataFrame, col: str) -> DataFrame:
    """Smallest, largest and number of the values that are not whole."""
    return df.filter(F.col(col) != F.floor(col)).agg(
        F.min(col).alias("min_value"), F.max(col).alias("max_value"), F.count("*").alias("cnt")
    )


def length_histogram(df: DataFrame, col: str) -> DataFrame:
    counted = df.groupBy(F.length(col).alias("length")).agg(F.count("*").alias("cnt"))
    return counted.orderBy(by("length"))


def length_lookup(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.filter(F.length(col) == n)


def preview(df: DataFrame, n: int, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Some ``n`` rows; with named columns the first by these and then all others.

    Without an order the first rows at hand are taken, and the table is not sorted.
    """
    if not order_by:
        return df.limit(n)
    return df.orderBy(*[by(c) for c in (*order_by, *rest_of(df, *order_by))]).limit(n)


def sample_rows(df: DataFrame, percentage: float, n: int | None, key: str, seed: int = 0) -> DataFrame:
    """A percentage of the rows, drawn by a hash of the key; of these at most ``n``, or all.

    A hash draw gives the same sample for any partitioning. The first eight hex
    digits of the hash are uniform, so the share of numbers below the threshold is
    the wanted percentage, and all are at 100. Rows without a key are drawn by all of
    their columns.
    """
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    text = F.coalesce(F.col(key).cast("string"), whole)
    draw = F.md5(F.concat_ws("#", text, F.lit(str(seed))).cast("binary"))
    drawn = df.withColumn("_draw", draw)
    drawn = drawn.filter(F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long") < int(percentage / 100 * 16**8))
    if n is not None:
        drawn = drawn.orderBy(F.col("_draw"), *[by(c) for c in df.columns]).limit(n)
    return drawn.drop("_draw")
