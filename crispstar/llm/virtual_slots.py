"""Sharding by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crispstar.llm.common import text_of
from crispstar.operators.keys import surrogate_key
from crispstar.session import materialize

SLOTS, SHARDS = 4096, 16
_SEED = 20_011
# What a map holds: of a slot, or of a piece of one of its texts (``hot``, by its hash), the shard.
MAP = "version int, virtual_slot int, hot long, piece int, pieces int, shard int"
# Stands for all texts of a slot that are not cut.
_REST = 0


def rebalanced(owner: dict, weight: dict, shards: int) -> dict:
    """The map ``owner`` edited until no move or swap of items evens out the heaviest and the lightest shard.

    Few items move: each step takes the one whose weight is nearest to half the
    gap, and where none fits, swaps the pair whose difference is. Works on as
    many items as there are slots, whatever the rows.
    """
    owner = dict(owner)
    load, held = [0] * shards, defaultdict(set)
    for item, shard in owner.items():
        load[shard] += weight[item]
        held[shard].add(item)

    def move(item, to: int) -> None:
        load[owner[item]] -= weight[item]
        held[owner[item]].discard(item)
        load[to] += weight[item]
        held[to].add(item)
        owner[item] = to

    for _ in range(4 * len(owner) + 64):
        high, low = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[high] - load[low]
        movable = [(abs(gap - 2 * weight[i]), i) for i in held[high] if 0 < weight[i] < gap]
        if movable:
            move(min(movable)[1], low)
            continue
        ups, downs = sorted((weight[i], i) for i in held[high]), sorted((weight[i], i) for i in held[low])
        best, j = None, 0
        for w, i in ups:
            while j < len(downs) and 2 * (w - downs[j][0]) > gap:
                j += 1
            for k in (j - 1, j):
                if 0 <= k < len(downs) and 0 < (d := w - downs[k][0]) < gap:
                    best = min(best or (gap, 0, 0), (abs(gap - 2 * d), i, downs[k][1]))
        if best is None:
            break
        move(best[1], low)
        move(best[2], high)
    return owner


def dealt(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """The first version of a map: the slots dealt in turn, whatever they will hold."""
    return spark.createDataFrame([(1, s, _REST, 0, 1, s % shards) for s in range(slots)], MAP)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the table of maps."""
    slot_map.coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, the newest unless one is named."""
    every = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.filter(F.col("version") == F.lit(version))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``id, size, text_crc32, virtual_slot, text_hash, row`` of every row, written once."""
    text = text_of(text_col)
    return materialize(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.xxhash64(F.lit(_SEED), text), F.lit(slots)).cast("int").alias("virtual_slot"),
            F.xxhash64(F.lit(_SEED + 1), text).alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )


def _pieced(rows: DataFrame, cut: dict[tuple[int, int], int]) -> DataFrame:
    """Rows with the ``hot`` text they belong to, if it is one of those cut, and the ``piece`` of it.

    A row's piece follows from its id; rows of such a text that share or lack an id are dealt by the row.
    """
    texts = rows.sparkSession.createDataFrame([(s, h, n) for (s, h), n in cut.items()], "virtual_slot int, hot long, pieces int")
    on = (rows["virtual_slot"] == texts["virtual_slot"]) & (rows["text_hash"] == texts["hot"])
    marked = rows.join(F.broadcast(texts), on, "left").drop(texts["virtual_slot"])  # fewer texts than shards
    shared = marked.filter(F.col("hot").isNotNull()).groupBy(F.col("hot").alias("of"), F.col("id").alias("of_id")).count().filter("count > 1")
    repeats = materialize(shared.select("of", "of_id", F.lit(True).alias("shared")), "shared-ids")
    same = (F.col("hot") == F.col("of")) & F.col("id").eqNullSafe(F.col("of_id"))
    dealt_by = F.when(F.col("shared") | F.col("id").isNull(), F.xxhash64(F.lit(_SEED), "row")).otherwise(F.xxhash64(F.lit(_SEED), "id"))
    piece = F.when(F.col("hot").isNotNull(), F.pmod(dealt_by, F.col("pieces"))).otherwise(0).cast("int")
    found = marked.join(repeats, same, "left").withColumn("piece", piece)
    return found.select("id", "size", "text_crc32", "virtual_slot", F.coalesce("hot", F.lit(_REST)).alias("hot"), "piece")


def edited_map(rows: DataFrame, earlier: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of a map, edited by the bytes that ``rows`` (of ``sized``) have in each slot.

    Texts that alone have more than a shard's share of the bytes are cut into pieces, each placed by itself, and stay
    cut in later versions; other texts of their slot stay together. Then few items move until the loads are even. What reaches the driver
    is a row per slot and piece: as many as the map has, whatever the rows.
    """
    spark = rows.sparkSession
    held = earlier.collect()
    version = max(r["version"] for r in held)
    owner = {(r["virtual_slot"], r["hot"], r["piece"]): r["shard"] for r in held}
    cut = {(r["virtual_slot"], r["hot"]): r["pieces"] for r in held if r["hot"] != _REST}
    per_slot = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    total = sum(r["bytes"] for r in per_slot)
    full = [r["virtual_slot"] for r in per_slot if r["bytes"] * shards > total]
    # Fewer than the shards: each has more than one of so many equal shares.
    hot = rows.filter(F.col("virtual_slot").isin(full)).groupBy("virtual_slot", "text_hash").agg(F.sum("size").alias("bytes"))
    for r in hot.filter(F.col("bytes") * shards > total).collect() if full else []:
        text = (r["virtual_slot"], r["text_hash"])
        if text not in cut:
            cut[text] = 4 * (r["bytes"] * shards // total + 1)
            owner |= {(*text, p): p % shards for p in range(cut[text])}
    pieces = _pieced(rows, cut).groupBy("virtual_slot", "hot", "piece").agg(F.sum("size").alias("bytes"))
    weight = dict.fromkeys(owner, 0) | {(r["virtual_slot"], r["hot"], r["piece"]): r["bytes"] for r in pieces.collect()}
    after = rebalanced(owner, weight, shards)
    return spark.createDataFrame([(version + 1, *i, cut.get(i[:2], 1), shard) for i, shard in sorted(after.items())], MAP)


def placed(rows: DataFrame, slot_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``sized`` in the shards that a version of the map says, numbered without gaps in each.

    Numbers follow slot, piece and id in one order of all rows, so no window sees a shard.
    """
    cut = {(r["virtual_slot"], r["hot"]): r["pieces"] for r in slot_map.filter(F.col("hot") != _REST).collect()}
    keys = ["virtual_slot", "hot", "piece"]
    found = _pieced(rows, cut).join(F.broadcast(slot_map.select(*keys, "shard", "version")), keys)  # a row per slot and piece
    ordered = surrogate_key(found, ["shard", *keys, "id", "text_crc32"], "place")
    first = materialize(ordered.groupBy("shard").agg(F.min("place").alias("first")), "first-places")
    numbered = ordered.join(F.broadcast(first), "shard")  # a row per shard
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"),
    )


def shard_by_slots(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Deal all rows to shards of near equal bytes by the map of slots that is stored at ``path``.

    A row's virtual slot is a hash of its text, so equal texts share a slot. Where no map is stored, the first
    version deals the slots in turn. The newest version is read, edited by the bytes now found in
    each slot, and stored as the next one; rows are placed by what was stored. A table that has grown
    is placed anew by few edits, so few of its rows move.

    Rows: ``id, size`` (bytes of the text plus 1)``, text_crc32, law, shard, slot``
    (a gapless number from 0 within the shard)``, grown_shard`` (NULL under this
    law)``, virtual_slot, map_version``. NULL texts count as empty and NULL ids
    come first within their slot; equal rows get different numbers; of a text that has
    more than a shard's share of the bytes the rows are dealt by id, or one by one where ids repeat or lack. An
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    try:
        earlier = read_map(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        save_map(dealt(spark, slots, shards), path)
        earlier = read_map(spark, path)
    rows = sized(docs, id_col, text_col, slots)
    save_map(edited_map(rows, earlier, shards), path)
    return placed(rows, read_map(spark, path), id_col)
