"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.session import materialize


def _hang(edges: DataFrame, up: bool) -> DataFrame:
    """Hang neighbours on the smallest of their group: the larger ones (``up``) or the smaller ones and the node."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if up:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if up:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``edges(a, b)``: the smallest node of its component.

    Large and small stars take turns until the edges are stars around the
    smallest nodes. Groups are only reduced to their minimum and joined back, a
    join that adaptive execution can split, so a node may have any number of
    neighbours. Each round is written, so a lost executor costs one round.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    now = materialize(ordered.distinct(), "edges")
    before = None
    while before != (mark := now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()):
        if not mark[0]:
            break
        before = mark
        now = materialize(_hang(_hang(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
