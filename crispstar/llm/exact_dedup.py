"""Exact duplicates, with the frequent texts taken out before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.llm.common import SPACE, identified, text_of, unused
from crispstar.session import materialize

COUNTERS = 1024


def shrink(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """A Misra-Gries summary of at most ``counters`` entries: what the next one counts is taken off all."""
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return {k: n - off for k, n in counts.items() if n > off}


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for x in batch.column("digest").value_counts().to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            held = shrink(held, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["digest", "n"]
        )

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each that more than ``2 / (counters + 1)`` of the rows have.

    A summary counts a digest too low by at most ``rows / (counters + 1)`` and
    never too high, and so do their sums. Hence at most ``counters`` sums can
    exceed that number: the bound of what is broadcast.
    """
    rows = digests.count()
    summaries = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, n long")
    return summaries.groupBy("digest").agg(F.sum("n").alias("n")).filter(F.col("n") > rows / (counters + 1)).select("digest")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None, counters: int = COUNTERS
) -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, text_sha256`` (and ``key``, where named).

    Texts are equal when they are identical after replacing each run of white
    space by one space; NULL counts as empty. The row with the smallest id stays,
    NULL ids last; of rows with one id the one read first. The digest is SHA-256.

    Frequent digests are found by Misra-Gries summaries, counted exactly with
    their winners, and settled on the map side against the broadcast winners;
    only the others are shuffled. Their groups are reduced to a minimum and a count, in part
    before the shuffle, and joined back, so no task holds a group. An empty table
    gives no rows; other columns are ignored.
    """
    digest = F.unhex(F.sha2(F.regexp_replace(text_of(text_col), SPACE, " "), 256))
    carried = [F.col(id_col).alias("id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row")]
    digests = materialize(docs.select(*carried, *([F.col(key).alias("key")] if key else [])), "digests")

    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    winners = materialize(
        digests.join(F.broadcast(frequent(digests, counters)), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(place).alias("first"), F.count("*").alias("group_size")),
        "winners",
    )
    heavy = digests.join(F.broadcast(winners), "digest")
    light = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = materialize(light.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("group_size")), "groups")
    light = light.join(groups, "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([F.col("key").alias(key)] if key else []),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are called.

    Of equal texts the row with the smallest id stays, NULL ids last, of rows with one id one of them.
    NULL and empty texts are one group; an empty table gives no rows.
    """
    key = unused(docs, "dedup_key")
    keyed = identified(docs, id_col, key)
    dropped = exact_duplicates(keyed, id_col, text_col, key).filter(~F.col("kept")).select(key)
    return keyed.join(dropped, key, "left_anti").select(*docs.columns)
