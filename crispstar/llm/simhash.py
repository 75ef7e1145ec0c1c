"""Near duplicates by SimHash fingerprints, linked with BK-trees."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from crispstar.llm.common import identified, in_arrow, raw, sliced, unused
from crispstar.llm.components import components
from crispstar.session import materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits: one is set if it is set in over half the XXH64 hashes of the shingles.

    A-Z count as a-z; shingles are that many words joined by a space, repeats
    included. A text with fewer words is one shingle, one without words has
    the fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxh64_intdigest(joined, SEED)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    set_in, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for i in range(0, n, _BLOCK):
        spans = zip(starts[i : min(i + _BLOCK, n)], starts[i + shingle :])
        hashes = np.array([xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` of every row; the fingerprint as a signed long."""

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for part in sliced(batch, "text"):
            for i, text in zip(part.column("id").to_pylist(), raw(part, "text")):
                fp = fingerprint(text, shingle)
                yield i, fp - (fp >> 63 << 64)

    return in_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, "id long, fp long")


class BKTree:
    """Integers; a child hangs on its parent under their Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        if len(self.values) == 1:
            return
        node = 0
        while True:
            under = self.children[node]
            child = under.setdefault((self.values[node] ^ value).bit_count(), len(self.values) - 1)
            if child == len(self.values) - 1:
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` away: by the triangle inequality only below edges that differ from
        the distance to their parent by no more than the radius."""
        found, open_ = [], [0] if self.values else []
        while open_:
            node = open_.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            under = self.children[node]
            for edge in range(max(d - radius, 0), d + radius + 1):
                if edge in under:
                    open_.append(under[edge])
        return found


def linked(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A pair (value, smallest linked value) for each value of a shard that hangs together with a smaller one."""
    tree, root = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    values = sorted(values)
    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
        tree.add(value)
    return [(v, values[top(i)]) for i, v in enumerate(values) if top(i) != i]


def masks(radius: int = RADIUS) -> list[int]:
    """What the shards keep of a fingerprint: all bytes but ``radius`` of the eight, in every choice.

    Two fingerprints that differ in at most ``radius`` bits differ in at most as
    many bytes, so they agree on what one of the masks keeps. Fingerprints that
    agree there differ in ``8 * radius`` bits at most: with two, a shard has
    65,536 fingerprints at most, whatever the data.
    """
    kept = []
    for out in combinations(range(8), radius):
        mask = sum(0xFF << 8 * i for i in range(8) if i not in out)
        kept.append(mask - (mask >> 63 << 64))
    return kept


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a, b`` that connect all of the distinct ``fp`` within the radius of each other.

    One shard per mask and kept bits; each fingerprint asks only the BK-trees
    of its own shards. A shard gives a star per group, not all of its pairs.
    """
    shards = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks(radius))]))
    members = (
        # A number of their own: few bytes of fingerprints would be few tasks, each with 28 rows for one.
        distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp").select("fp", shards.alias("shard"))
        .groupBy("shard.mask", "shard.bits")
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
    )

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for fps in batch.column("fps").to_pylist():
            yield from ((a - (a >> 63 << 64), b - (b >> 63 << 64)) for a, b in linked([x % (1 << 64) for x in fps], radius))

    return in_arrow(members, rows, "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``id, fingerprint`` (16 hex digits)``, component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    the component is named after the smallest id that links reach, NULL if all
    its ids are. NULL and empty texts have the fingerprint 0 and are linked like
    any other. Repeated rows are rows of one component. Copies collapse into one
    fingerprint before anything is compared.
    """
    found = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(found.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    label = components(links(distinct, radius))
    nodes = distinct.join(label, distinct["fp"] == label["node"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = nodes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = materialize(nodes.join(smallest, "label").select("fp", "component_id"), "named-fingerprints")
    return found.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component, with its columns, whatever these are called.

    The row with the smallest id stays, NULL ids last; of rows with one id the one read first. All texts without
    words, NULL and empty ones included, are one component; an empty table gives no rows.
    """
    key = unused(docs, "near_key")
    keyed = identified(docs, id_col, key)
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    ids = keyed.select(F.col(key).alias("row"), F.col(id_col).cast("long").alias("id"))
    found = simhash_components(keyed, key, text_col).select(F.col(key).alias("row"), "component_id")
    kept = found.join(ids, "row").groupBy("component_id").agg(F.min(place)["row"].alias(key)).select(key)
    return keyed.join(kept, key, "left_semi").select(*docs.columns)
