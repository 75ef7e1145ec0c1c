"""Exact top-k by inner product: score histograms locate the k-th value, then one filter."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import floor
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crispstar.llm.common import arrow_types, batched, identified
from crispstar.session import materialize, scratch_path

K, SCALE = 5, 256
# Bytes of scaled query vectors per block, bins per histogram as a power of two, candidate rows scored at once.
BLOCK_BYTES, BIN_BITS, CHUNK = 8 << 20, 9, 512
# Vectors with a scaled component of this size or more are scored one by one, in integers without bounds.
LARGEST = 1 << 26


class Block:
    """Scaled query vectors of one block, by dimension, with the range in which each one's k-th score lies."""

    def __init__(self, keys: list[int], vectors: list[list[int]], k: int):
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        vectors = [vectors[i] for i in order]
        dims = np.array([len(v) for v in vectors])
        self.groups = {int(d): (at, np.array([vectors[i] for i in at], np.int64).reshape(len(at), d)) for d in np.unique(dims) for at in [np.flatnonzero(dims == d)]}
        self.need = np.full(len(keys), k, np.int64)  # scores still to be found within the range
        self.low = np.full(len(keys), -(1 << 62), np.int64)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and scaled vectors of a batch, one matrix per dimension and chunk."""
    column = batch.column("q")
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        for i in range(0, len(at), CHUNK):
            rows = at[i : i + CHUNK]
            yield rows, values[offsets[rows][:, None] + np.arange(d)].astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles where their sums stay below 2**53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _scored(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple]:
    """Scores of all candidates against the block: ids, keys, query numbers, matrix, and which to leave out."""
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        ids = batch.column("id")
        for rows, vectors in _vectors(batch):
            if vectors.shape[1] not in block.groups:
                continue
            numbers, queries = block.groups[vectors.shape[1]]
            own = keys[rows][:, None] == block.keys[numbers][None, :]
            yield ids.take(pa.array(rows)).to_pylist(), keys[rows], numbers, _product(vectors, queries), own


def _histograms(block: Broadcast, shift: int, bits: int):
    """``query, bin, n``: the highest bins of each query in this task's rows that hold enough scores."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        b, bins = block.value, 1 << bits
        counts = np.zeros(len(b.keys) * bins, np.int64)
        for _, _, numbers, scores, own in _scored(batches, b):
            at = (scores - b.low[numbers][None, :]) >> shift
            inside = (at >= 0) & (at < bins) & ~own
            counts += np.bincount((at + numbers[None, :] * bins)[inside], minlength=len(counts))
        counts = counts.reshape(len(b.keys), bins)
        higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        for q, x in zip(*np.nonzero((counts > 0) & (higher < b.need[:, None]))):
            yield int(q), int(x), int(counts[q, x])

    return rows


def _winners(block: Broadcast, k: int):
    """``query, id, key, score``: what this task's rows can contribute to the results.

    Scores above the k-th value are fewer than k in all; of those equal to it, the
    k smallest ids of the task suffice.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        b = block.value
        ties: dict[int, list[tuple]] = {}
        for ids, keys, numbers, scores, own in _scored(batches, b):
            low = b.low[numbers][None, :]
            for i, j in zip(*np.nonzero((scores > low) & ~own)):
                yield int(numbers[j]), ids[i], int(keys[i]), int(scores[i, j])
            equal = (scores == low) & ~own
            for j in np.flatnonzero(equal.any(axis=0)):
                q = int(numbers[j])
                new = [(ids[i] is None, ids[i] or 0, int(keys[i])) for i in np.flatnonzero(equal[:, j])]
                ties[q] = sorted(ties.get(q, []) + new)[:k]
        for q, held in ties.items():
            yield from ((q, None if none else i, key, int(b.low[q])) for none, i, key in held)

    return rows


def _over(table: DataFrame, rows, schema: str) -> DataFrame:
    names, types = arrow_types(table, schema)
    return table.mapInArrow(lambda it: batched(rows(it), names, types), schema)


def _search(table: DataFrame, queries: list, k: int, bits: int, largest: int) -> DataFrame:
    """``query, id, key, score, rank`` of one block of queries; no component of the table is above ``largest``."""
    context = table.sparkSession.sparkContext
    block = Block([r["key"] for r in queries], [r["q"] for r in queries], k)
    most = max(int(np.abs(m).max(initial=0)) * max(m.shape[1], 1) for _, m in block.groups.values())
    most = max(1, most * max(largest, 1))
    # Refine the range around each k-th value, a power of two wide, until it is one value.
    width = most.bit_length() + 1
    block.low[:] = -(1 << (width - 1))
    while width > 0:
        shift = max(0, width - bits)
        counted = _over(table, _histograms(context.broadcast(block), shift, width - shift), "query int, bin int, n long")
        downward = Window.partitionBy("query").orderBy(F.col("bin").desc())
        summed = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(downward))
        here = (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))
        located = summed.join(_needs(table.sparkSession, block), "query").filter(here)
        for r in located.collect():  # one row a query of the block at most
            block.low[r["query"]] += r["bin"] << shift
            block.need[r["query"]] -= r["upto"] - r["n"]
        width = shift
    found = _over(table, _winners(context.broadcast(block), k), "query int, id long, key long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _needs(spark, block: Block) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(block.need)], "query int, need long"))


def _whole(q: list[int] | None, raw: list[float] | None, scale: int) -> list[int]:
    """The scaled components as integers of any size. From 2**53 on a double is an integer."""
    if q is not None:
        return q
    return [scale * int(x) if abs(x) >= 1 << 53 else floor(scale * x) for x in raw]


def _order(score: int) -> str:
    """Digits that sort as the integers do, of any size."""
    digits = f"{len(str(abs(score))):06}{abs(score)}"
    return f"1{digits}" if score >= 0 else "0" + "".join(str(9 - int(d)) for d in digits)


def _exactly(table: DataFrame, queries: list[tuple[int, list[int]]], k: int, scale: int) -> DataFrame:
    """``query, id, key, score, place``: the best ``k`` that each task's rows can contribute to each query (by its key)."""
    sent = table.sparkSession.sparkContext.broadcast(queries)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for key, i, q, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "q", "raw"))):
                vector = _whole(q, raw, scale)
                for asking, asked in sent.value:
                    if asking != key and len(asked) == len(vector):
                        held = best.setdefault(asking, [])
                        held.append((-sum(map(mul, asked, vector)), i is None, i or 0, key))
                        if len(held) > 64 * k:
                            best[asking] = sorted(held)[:k]
        for asking, held in best.items():
            for less, none, i, key in sorted(held)[:k]:
                # A score beyond a long is given as the nearest long, and ranked by what it is.
                yield asking, None if none else i, key, max(-(1 << 63), min((1 << 63) - 1, -less)), _order(-less)

    return _over(table, rows, "query long, id long, key long, score long, place string")


def _with_large(table: DataFrame, found: DataFrame, k: int, scale: int, per_block: int) -> DataFrame:
    """``found`` (``query, id, key, score``) and all pairs with a large vector on either side, ranked together."""
    digits = F.abs(F.col("score").cast("decimal(20,0)")).cast("string")
    sized = F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
    place = F.when(F.col("score") >= 0, F.concat(F.lit("1"), sized)).otherwise(F.concat(F.lit("0"), F.translate(sized, "0123456789", "9876543210")))
    every = found.select("query", "id", "key", "score", place.alias("place"))
    for asking, candidates in ((table, table.filter("raw IS NOT NULL")), (table.filter("raw IS NOT NULL"), table.filter("q IS NOT NULL"))):
        last = None
        while True:
            rest = asking.filter("is_query") if last is None else asking.filter("is_query").filter(F.col("key") > last)
            queries = rest.orderBy("key").limit(per_block).collect()  # a block of vectors
            if not queries:
                break
            last = queries[-1]["key"]
            sent = [(r["key"], _whole(r["q"], r["raw"], scale)) for r in queries]
            every = every.unionByName(materialize(_exactly(candidates, sent, k, scale), "exactly"))
    best = Window.partitionBy("query").orderBy(F.col("place").desc(), F.col("id").asc_nulls_last(), "key")
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    k: int = K, scale: int = SCALE, block_bytes: int = BLOCK_BYTES, bin_bits: int = BIN_BITS,
) -> DataFrame:
    """``query_id, rank, id, score``: each query's ``k`` highest scores among all other rows.

    Components become ``floor(scale * x)``; the score is the integer inner product
    with rows of the same dimension. Ties go to the smaller id, NULL ids last, then
    to the row read first. Queries are the rows for which ``is_query`` holds, in
    blocks of a fixed number of bytes: every block scores all rows, sums histograms
    of the scores over all tasks, and narrows each query's range to the bin of its
    k-th value until that value is known; a last pass takes the scores above it and
    the smallest ids of those equal to it.

    Vectors with a scaled component of 2**26 or more, whose scores might leave a long, are scored beside that in
    integers of any size, as queries and as candidates; a score beyond a long is ranked as
    it is and given as the nearest long. Vectors that are NULL or hold a NULL or a non-finite component take no part. With
    fewer than ``k`` other rows a query gets all. Repeated ids are rows of their own.
    An empty table gives no rows.
    """
    keyed = identified(vectors, id_col)
    finite = F.forall(vec_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    fits = F.forall(vec_col, lambda x: F.abs(x.cast("double")) < LARGEST / scale)
    scaled = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    table = materialize(
        keyed.filter(F.col(vec_col).isNotNull() & finite).select(
            F.col("row_key").alias("key"), F.col(id_col).cast("long").alias("id"), F.when(fits, scaled).alias("q"),
            F.when(~fits, F.col(vec_col).cast("array<double>")).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ),
        "scaled",
    )
    spark, out = vectors.sparkSession, scratch_path(vectors.sparkSession, "top")
    schema = "query long, query_id long, rank int, id long, key long, score long"
    asking = table.filter("is_query AND q IS NOT NULL")
    largest, size, large = table.agg(
        F.max(F.array_max(F.transform("q", F.abs))), F.max(F.when(F.col("is_query"), F.greatest(F.size("q"), F.size("raw")))), F.count("raw")
    ).first()
    per_block, last = max(1, block_bytes // (8 * max(1, size or 1))), None
    spark.createDataFrame([], schema).write.parquet(out)
    while True:
        rest = asking if last is None else asking.filter(F.col("key") > last)
        queries = rest.orderBy("key").limit(per_block).collect()  # at most block_bytes of vectors
        if not queries:
            break
        ids = [(i, r["key"], r["id"]) for i, r in enumerate(sorted(queries, key=lambda r: r["key"]))]
        named = F.broadcast(spark.createDataFrame(ids, "number int, query long, query_id long"))
        found = _search(table.filter("q IS NOT NULL").select("key", "id", "q"), queries, k, bin_bits, largest or 1).withColumnRenamed("query", "number")
        found.join(named, "number").select("query", "query_id", "rank", "id", "key", "score").write.mode("append").parquet(out)
        last = queries[-1]["key"]
    found = spark.read.schema(schema).parquet(out)
    if large:
        names = table.filter("is_query").select(F.col("key").alias("query"), F.col("id").alias("query_id"))
        found = _with_large(table, found, k, scale, per_block).join(names, "query")
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")
