"""Token ids in training order: fixed-stride binary shards."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crispstar.llm.common import arrow_types, batched, in_arrow, raw, sliced, text_of
from crispstar.session import materialize

LENGTH = 256
SHARD_BYTES = 16 << 20
LEAST_SHARDS = 64
# So many rows of a manifest, 16 bytes each, are broadcast at most.
_BROADCAST_SHARDS = 1 << 20
_HEAD = np.dtype([("position", "<i4"), ("part", "<i4"), ("doc_id", "<i8"), ("n", "<i4"), ("has_id", "<i4")])


def feistel(index: np.ndarray, size: int, key: bytes, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of ``0 .. size - 1``, applied to ``index``.

    A balanced Feistel network permutes the next power of four; what leaves the
    range walks its cycle until it is back in it, at most about four steps on average.
    """
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(blake2b(key, digest_size=8 * rounds).digest(), "<u8")

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        return left << np.uint64(half) | right

    with np.errstate(over="ignore"):
        out = once(index.astype(np.uint64))
        while len(outside := np.flatnonzero(out >= size)):
            out[outside] = once(out[outside])
    return out.astype(np.int64)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base64 and its id per line."""
    return {base64.b64decode(t): int(i) for t, i in map(bytes.split, Path(path).read_bytes().splitlines())}


def _indexed(docs: DataFrame, most_parts: int) -> tuple[DataFrame, int]:
    """``id, text, index`` with a number below the returned size that no two rows share.

    The id itself, from the smallest on, where ids are unique, not NULL and close enough together; otherwise the rows
    are written once, in whatever order they come, and numbered by their partition and place.
    """
    ids = docs.agg(F.min("id"), F.max("id"), F.count("*"), F.count("id")).first()
    if not ids[2]:
        return docs.withColumn("index", F.lit(0).cast("long")), 1
    span = (ids[1] - ids[0] + 1) if ids[3] else 0
    if ids[2] == ids[3] and span * most_parts < 1 << 60 and docs.groupBy("id").count().filter("count > 1").isEmpty():
        return docs.withColumn("index", F.col("id") - ids[0]), span
    written = materialize(docs.withColumn("stamp", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("stamp", 33)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = written.join(F.broadcast(materialize(starts, "starts")), part == F.col("part"))  # one row a partition
    return numbered.select("id", "text", (F.col("before") + F.col("stamp").bitwiseAND(F.lit((1 << 33) - 1))).alias("index")), ids[2]


def sequences(docs: DataFrame, path: str, pattern: str, end_id: int, length: int, most_parts: int, size: int, key: bytes) -> DataFrame:
    """``doc_id, part, ids, place``: each text's ids with the end id, cut to ``length``, two bytes an id; ``place`` in the permuted range.

    The number of a sequence is ``index * most_parts + part``, and its place what the permutation of
    ``0 .. size * most_parts - 1`` makes of it.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    known: list[tiktoken.Encoding] = []

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        if not known:
            known.append(tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={}))
        for piece in sliced(batch, "text"):
            cut = []
            for i, index, text in zip(piece.column("id").to_pylist(), piece.column("index").to_pylist(), raw(piece, "text")):
                ids = np.array([*known[0].encode_ordinary(text.decode("utf-8", "replace")), end_id], "<u2")
                cut += [(i, part, ids[at : at + length].tobytes(), index * most_parts + part) for part, at in enumerate(range(0, len(ids), length))]
            places = feistel(np.array([c[3] for c in cut], np.int64), size * most_parts, key).tolist()
            yield from ((*c[:3], place) for c, place in zip(cut, places))

    return in_arrow(docs, rows, "doc_id long, part int, ids binary, place long")


def _records(length: int):
    """Records of each shard from sequences sorted by shard and place, numbered as they come."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard, at = None, 0
        record = np.zeros(1, np.dtype([("head", _HEAD), ("ids", "<u2", (length,))]))
        for batch in batches:
            for doc_id, part, ids, of in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids", "shard"))):
                shard, at = of, at + 1 if of == shard else 0
                record["head"] = (at, part, doc_id or 0, len(ids) // 2, doc_id is not None)
                record["ids"][0, : len(ids) // 2] = np.frombuffer(ids, "<u2")
                record["ids"][0, len(ids) // 2 :] = 0
                yield shard, at, record.tobytes()

    return rows


def write_shards(
    docs: DataFrame, out: str, path: str, pattern: str, end_id: int, key: bytes,
    length: int = LENGTH, shard_bytes: int = SHARD_BYTES, least_shards: int = LEAST_SHARDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write every text as sequences of ``length`` two-byte ids into shards below ``out``.

    Every sequence has a number, made of its document's and its part, and one keyed Feistel permutation of the
    range of these numbers gives its place in the global order. A shard is a range of places, equal for all shards,
    so a third of equal rows spreads like any others; its records stand in
    the order of places. One shuffle moves the ids, and one file per shard holds records of one size
    (``stride``), so that any slot is found by a multiplication. Shards hold
    ``shard_bytes`` on average, and a task holds one record at a time.

    Numbers are not gapless, because how many sequences a text has is known only once it is encoded;
    slots are: a shard's first is the number of records in the shards before, which ``manifest`` tells.

    Short sequences are padded with zeros; their length stands in the record. A
    NULL or empty text is one sequence with the end id alone. NULL ids are kept
    as such; repeated rows are sequences of their own; an empty table writes no shard. Unique ids give
    one order however the table is partitioned; rows with NULL or repeated ids are numbered as they are read.
    """
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    total, longest = read.agg(F.sum(F.octet_length("text") + 2 * length), F.max(F.octet_length("text"))).first()
    shards = max(least_shards, (total or 0) // shard_bytes + 1)
    # A token has a byte at least.
    most_parts = (longest or 0) // length + 1
    indexed, size = _indexed(read, most_parts)
    width = -(-size * most_parts // shards)
    cut = sequences(indexed, path, pattern, end_id, length, most_parts, size, key)
    ranged = cut.withColumn("shard", F.call_function("div", F.col("place"), F.lit(width)).cast("int"))
    grouped = ranged.repartition("shard").sortWithinPartitions("shard", "place").select("shard", "doc_id", "part", "ids")
    make, (names, types) = _records(length), arrow_types(docs, "shard int, position int, record binary")
    records = grouped.mapInArrow(lambda it: batched(make(it), names, types, 4000), "shard int, position int, record binary")
    # The text writer puts out the bytes of a string as they are, and one line feed.
    lines = records.sortWithinPartitions("shard", "position").select("shard", F.col("record").cast("string"))
    lines.write.partitionBy("shard").text(out)


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: its head, its ids, a line feed."""
    return _HEAD.itemsize + 2 * length + 1


def _shard_files(spark: SparkSession, out: str) -> DataFrame:
    found = spark.read.format("binaryFile").load(out)
    return found if "shard" in found.columns else found.withColumn("shard", F.lit(0))  # no shard was written


def manifest(spark: SparkSession, out: str, length: int = LENGTH) -> DataFrame:
    """``shard, first_slot, n_slots`` of each shard: one row a shard, from the sizes of the files."""
    sizes = _shard_files(spark, out).select("shard", (F.col("length") / stride(length)).cast("long").alias("n_slots"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n_slots").over(before), F.lit(0)).alias("first_slot"), "n_slots")


def read_shards(spark: SparkSession, out: str, length: int = LENGTH, start: int = 0, stop: int | None = None) -> DataFrame:
    """``slot, shard, doc_id, part, n_tokens, ids`` of the slots from ``start`` up to ``stop``.

    A reader that resumes reads only the shards from its slot on.
    """
    ranges = manifest(spark, out, length).filter(F.col("first_slot") + F.col("n_slots") > start)
    if stop is not None:
        ranges = ranges.filter(F.col("first_slot") < stop)
    ranges = ranges.select("shard", "first_slot")
    if ranges.count() <= _BROADCAST_SHARDS:
        ranges = F.broadcast(ranges)
    files = _shard_files(spark, out).select("shard", "content").join(ranges, "shard")
    size = stride(length)

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for shard, first, content in zip(*(batch.column(c) for c in ("shard", "first_slot", "content"))):
            data = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, size)
            heads = data[:, : _HEAD.itemsize].copy().view(_HEAD)[:, 0]
            ids = data[:, _HEAD.itemsize : -1].copy().view("<u2")
            slots = first.as_py() + np.arange(len(data))
            for i in np.flatnonzero((slots >= start) & (slots < (stop if stop is not None else slots[-1] + 1))):
                head = heads[i]
                doc_id = int(head["doc_id"]) if head["has_id"] else None
                yield int(slots[i]), shard.as_py(), doc_id, int(head["part"]), int(head["n"]), ids[i, : head["n"]].tobytes()

    schema = "slot long, shard int, doc_id long, part int, n_tokens int, ids binary"
    return in_arrow(files, rows, schema, 4000)


def digests(read: DataFrame) -> DataFrame:
    """The read sequences with the SHA-256 of their two-byte ids in place of them."""
    return read.select("slot", "shard", "doc_id", "part", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


def ids_digest(ids: list[int]) -> str:
    """The digest of a list of ids, as ``digests`` gives it."""
    return sha256(np.array(ids, "<u2").tobytes()).hexdigest()
