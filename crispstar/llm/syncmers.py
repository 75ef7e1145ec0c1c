"""Fingerprints of closed syncmers, and how alike two of them are by the order of their anchors.

A stretch of ``K`` characters is an anchor if the smallest of the hashes of its stretches of
``S`` characters is its first or its last. Whether one is depends on its own characters alone,
so an edit changes only the anchors that it touches. Of random text about two in K - S + 2
places are anchors, and no stretch of K + K - S - 1 characters is without.
"""

from __future__ import annotations

from base64 import b64encode
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from crispstar.llm.common import arrow_types, batched, raw, sliced, text_of
from crispstar.session import materialize

K, S = 32, 8
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
# Bytes of text that are hashed at once.
_BLOCK = 1 << 18


def _rolled(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive values, put together from stretches of powers of two."""
    out, covered, step, length = None, 0, values, 1
    while True:
        if size & length:
            if out is None:
                out = step
            else:
                n = min(len(out), len(step) - covered)
                out = out[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + step[covered : covered + n]
            covered += length
        if length * 2 > size:
            return out
        n = max(len(step) - length, 0)
        step = step[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + step[length : length + n]
        length *= 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` consecutive values."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def closed_syncmers(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and 64-bit hashes of the anchors of each text.

    Neighbouring anchors with one hash, as in a run of one character, count once. A
    text that has no anchor, like one below ``k`` characters, is one as a whole; an empty text has none.
    """
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    begins = ends - [len(t) for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    n = max(len(points) - k + 1, 0)
    picked, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n:
        inner = _mixed(_rolled(points, s))
        least = _least(inner, k - s + 1)
        chosen = (inner[:n] == least) | (inner[k - s : k - s + n] == least)
        for end in ends:
            chosen[max(end - k + 1, 0) : end] = False  # over the end of a text
        picked = np.flatnonzero(chosen)
        hashes = _mixed(_rolled(points, k))[picked]
    cuts = np.searchsorted(picked, np.r_[begins, len(points)])
    found = []
    for text, begin, a, b in zip(texts, begins, cuts, cuts[1:]):
        at, h = picked[a:b] - begin, hashes[a:b]
        if len(h) > 1:
            new = np.r_[True, h[1:] != h[:-1]]
            at, h = at[new], h[new]
        if not len(h) and text:
            at, h = np.zeros(1, np.int64), np.array([xxh64_intdigest(text.encode())], np.uint64)
        found.append((at, h))
    return found


def _short(hashes: np.ndarray) -> np.ndarray:
    """The first 24 bits of each hash, which is what a fingerprint keeps of it."""
    return (hashes >> np.uint64(40)).astype(np.uint32)


def _text(anchors: np.ndarray) -> str:
    """Four characters of base64 an anchor, in the order of the text."""
    return b64encode(anchors.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of anchors that match in order, from 0 to 1; of two empty fingerprints 1.

    Equal beginnings and ends match. Between them the first occurrence of an anchor in one may match the
    first in the other, the second the second and so on, and the longest chain of these that
    ascends in both counts.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shorter = min(len(a), len(b))
    same = a[:shorter] == b[:shorter]
    head = shorter if same.all() else int(same.argmin())
    same = a[len(a) - shorter + head :][::-1] == b[len(b) - shorter + head :][::-1]
    tail = len(same) if same.all() else int(same.argmin())
    inner_a, inner_b = a[head : len(a) - tail], b[head : len(b) - tail]
    matched = head + tail
    shared = np.intersect1d(inner_a, inner_b)
    if len(shared):
        places = defaultdict(list)
        for i in np.flatnonzero(np.isin(inner_b, shared)).tolist():
            places[int(inner_b[i])].append(i)
        seen, chain = defaultdict(int), []
        for i in np.flatnonzero(np.isin(inner_a, shared)).tolist():
            v = int(inner_a[i])
            nth = seen[v]
            seen[v] += 1
            if nth < len(places[v]):
                at = bisect_left(chain, places[v][nth])
                chain[at : at + 1] = [places[v][nth]]
        matched += len(chain)
    return 2 * matched / (len(a) + len(b))


def fingerprints(texts: list[str], k: int = K, s: int = S) -> list[np.ndarray]:
    """The anchors of each text, in order, as 24-bit numbers."""
    return [_short(h) for _, h in closed_syncmers(texts, k, s)]


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``id, at, hash`` of every anchor of every text: what positions are matched by.

    NULL and empty texts have none; repeated rows have theirs each; other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for block, texts in _blocks(batch):
                for i, (at, hashes) in zip(block.column("id").to_pylist(), closed_syncmers(texts, k, s)):
                    yield from ((i, x, h) for x, h in zip(at.tolist(), hashes.view(np.int64).tolist()))

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    names, types = arrow_types(read, "id long, at long, hash long")
    return read.mapInArrow(lambda it: batched(rows(it), names, types), "id long, at long, hash long").withColumnRenamed("id", id_col)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows with about a block's size of text, so that no batch is copied whole."""
    for rows in sliced(batch, "text", _BLOCK):
        yield rows, [t.decode("utf-8", "replace") for t in raw(rows, "text")]


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by the first as many characters of another (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(k: int, s: int):
    """Rows in the order of ids, each part ending with the row that follows it, which is marked ``look``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last: list[tuple] = []
        for batch in batches:
            for block, texts in _blocks(batch):
                met = [*last, *zip(*(block.column(c).to_pylist() for c in ("id", "part", "look")), texts, fingerprints(texts, k, s))]
                pairs = [(a, b) for a, b in pairwise(met) if a[1] == b[1]]
                changed = [edited(a[3], b[3]) for a, b in pairs]
                for (a, b), text, other in zip(pairs, changed, fingerprints(changed, k, s)):
                    digest = sha256(text.encode()).hexdigest()
                    yield a[0], len(a[3]), digest, _text(a[4]), _text(other), likeness(a[4], other), likeness(a[4], b[4])
                last = met[-1:]

    return rows


def _sortable(number: Column) -> Column:
    """Sixteen hex digits in the order of a signed long."""
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def _part(key: Column, starts: list[str]) -> Column:
    """The place of the last of the ascending ``starts`` that is not above the key, by bisection."""
    listed = F.lit(starts)
    middle = lambda a: F.floor((a["lo"] + a["hi"]) / 2).cast("int")
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(starts)).alias("hi"))
    halved = lambda a, _: F.when(
        F.get(listed, middle(a)) <= key, F.struct(middle(a).alias("lo"), a["hi"].alias("hi"))
    ).otherwise(F.struct(a["lo"].alias("lo"), middle(a).alias("hi")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(starts).bit_length())), start, halved, lambda a: a["lo"])


def _in_order(docs: DataFrame) -> DataFrame:
    """``id, text`` with a ``key`` that no two rows share: by id, NULL first, equal ids by the digest of their text."""
    if docs.groupBy("id").count().filter(F.col("id").isNull() | (F.col("count") > 1)).isEmpty():
        return docs.withColumn("key", _sortable(F.col("id")))
    digest = F.substring(F.sha2(text_of("text").cast("binary"), 256), 1, 32)
    by_id = F.coalesce(F.concat(F.lit("1"), _sortable(F.col("id"))), F.lit("0"))
    # Written, because a number that is computed anew after a lost executor could differ.
    return materialize(docs.withColumn("key", F.concat(by_id, F.lit(":"), digest, F.hex(F.monotonically_increasing_id()))), "in-order")


def syncmer_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per document: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    ``edited`` is the text with its last half replaced by the beginning of the next document's, in the order of
    ids, after the last the first; one document is its own next. Likeness is of the document's fingerprint
    to that of the edited text and to that of the next document.

    NULL counts as empty and has an empty fingerprint. NULL ids come first; rows of one id follow each other by
    the digest of their text, so of repeated rows all but one are followed by their like. An empty table gives no rows;
    other columns are ignored.

    Ids alone are cut into ranges first. The texts are then shuffled once, each to its range, and the
    first document of a range also to the range before, so that each meets the next in its task.
    """
    spark = docs.sparkSession
    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ordered = _in_order(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ordered.select("key").repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("start"))
    starts = sorted(r["start"] for r in ranges.collect())  # one a partition
    if not starts:
        return spark.createDataFrame([], schema)
    own = F.struct(F.col("part"), F.lit(False).alias("look"))
    before = F.struct((F.when(F.col("part") == 0, len(starts)).otherwise(F.col("part")) - 1).cast("int").alias("part"), F.lit(True).alias("look"))
    is_start = F.get(F.lit(starts), F.col("part")) == F.col("key")
    sent = (
        ordered.withColumn("part", _part(F.col("key"), starts))
        .select("id", "text", "key", F.explode(F.when(is_start, F.array(own, before)).otherwise(F.array(own))).alias("to"))
        .select("id", "text", "key", F.col("to.part").alias("part"), F.col("to.look").alias("look"))
    )
    met = sent.repartitionById(len(starts), "part").sortWithinPartitions("part", "look", "key").select("id", "text", "part", "look")
    names, types = arrow_types(met, schema)
    rows = _compared(k, s)
    return met.mapInArrow(lambda batches: batched(rows(batches), names, types, 200), schema)
