"""Spelling tables and the lookup that applies them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.functions.columns import as_column

# Accepted spellings of each standard value, compared after
# trimming blanks and lowering case.
STATUS = {
    "success": ("success", "suc"),
    "failed": ("failed", "fail"),
    "refunded": ("refunded", "ref"),
}
STATUS_DRAFT = {"refunded": ("ref",)}
PAYMENT = {
    "card": ("card", "crad", "c@rd", "cd"),
    "wallet": ("wallet", "wall-et"),
    "upi": ("upi",),
    "cash": ("cash",),
}
PAYMENT_DRAFT = {"card": ("crad",)}
CATEGORY = {
    "clothing": ("clo", "clothing", "clothing_", "clothing-"),
    "electronics": ("ele", "electronics", "electronics_", "3l3ctronics"),
    "automotive": ("aut", "automotive", "automotive_", "automotive-", "automotiv3"),
    "home": ("hom", "home", "home_", "home-", "hom3"),
    "kitchen": ("kit", "kitchen", "kitchen-", "kitch3n"),
    "toys": ("toy", "toys", "toys-"),
    "beauty": ("bea", "beauty", "beauty_", "beauty-", "b3auty"),
    "sports": ("sports", "sports-"),
}
CATEGORY_DRAFT = CATEGORY | {
    "kitchen": (*CATEGORY["kitchen"], "kitchen_"),
    "toys": (*CATEGORY["toys"], "toys_"),
    "sports": (*CATEGORY["sports"], "sports_"),
}
ISSUE = {
    "Product": ("product", "pro", "product_", "productx", "tcudorp"),
    "Payment": ("payment", "pay", "payment_", "paymentx", "paym3nt", "tnemyap"),
    "Delay": ("delay", "del", "delay_", "delayx", "d3lay", "yaled"),
    "Refund": ("refund", "ref", "refund_", "refundx", "r3fund", "dnufer"),
}
SENTIMENT = {
    "Positive": ("positive", "pos", "positiv3"),
    "Negative": ("negative", "neg", "n3gativ3"),
    "Neutral": ("neutral", "neu", "n3utral"),
}

FALLBACKS = ("null", "raw", "normalized")


def _normalized(col: Column) -> Column:
    return F.lower(F.trim(col))


def _with_fallback(found: Column, col: Column, otherwise: str) -> Column:
    if otherwise not in FALLBACKS:
        raise ValueError(f"otherwise must be one of {FALLBACKS}, not {otherwise!r}")
    if otherwise == "raw":
        return F.coalesce(found, col)
    if otherwise == "normalized":
        return F.coalesce(found, _normalized(col))
    return found


def map_synonyms(col: Column | str, table: dict[str, tuple[str, ...]], otherwise: str = "null") -> Column:
    """Standard value of a spelling; unknown text becomes NULL, stays raw or is normalized.

    The table is folded into one map literal, so the text is normalized once
    per row whatever the number of values. Tables that grow go through
    ``synonym_join``.
    """
    c = as_column(col)
    entries = [F.lit(x) for value, spellings in table.items() for s in spellings for x in (s, value)]
    return _with_fallback(F.try_element_at(F.create_map(*entries), _normalized(c)), c, otherwise)


def synonym_join(
    df: DataFrame, col: str, mapping: DataFrame, spelling: str, value: str, otherwise: str = "null"
) -> DataFrame:
    """Same lookup for a mapping kept as a table with one row per spelling.

    Catalyst broadcasts the mapping while its files are below the broadcast
    threshold and otherwise joins by shuffle.
    """
    lookup = mapping.select(F.col(spelling).alias("_spelling"), F.col(value).alias("_value"))
    joined = df.join(lookup, _normalized(df[col]) == F.col("_spelling"), "left")
    standard = _with_fallback(F.col("_value"), F.col(col), otherwise)
    return joined.withColumn(col, standard).select(*df.columns)


def standardize_status(col: Column | str, draft: bool = False) -> Column:
    if draft:
        return map_synonyms(col, STATUS_DRAFT, "normalized")
    return map_synonyms(col, STATUS)


def standardize_payment(col: Column | str, draft: bool = False) -> Column:
    if draft:
        return map_synonyms(col, PAYMENT_DRAFT, "normalized")
    return map_synonyms(col, PAYMENT)


def standardize_category(col: Column | str, variant: str = "published") -> Column:
    """``published`` keeps unknown text raw, ``draft`` knows more spellings, ``audit`` returns NULL."""
    table, otherwise = {
        "published": (CATEGORY, "raw"),
        "draft": (CATEGORY_DRAFT, "raw"),
        "audit": (CATEGORY, "null"),
    }[variant]
    return map_synonyms(col, table, otherwise)


def standardize_issue(col: Column | str) -> Column:
    return map_synonyms(col, ISSUE)


def standardize_sentiment(col: Column | str) -> Column:
    return map_synonyms(col, SENTIMENT)
