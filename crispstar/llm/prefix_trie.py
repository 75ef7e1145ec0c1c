"""The trie of conversation beginnings, with sums over its subtrees by centroid decomposition."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.llm.centroid import subtree_sums
from crispstar.llm.common import arrow_types, batched
from crispstar.operators.keys import surrogate_key
from crispstar.session import materialize

# Conversations share beginnings in families of so many neighbouring ids, up to so many turns.
FAMILY, SHARED = 5, 8
# Bytes of ids put together before they are handed on to be hashed.
_PIECE = 1 << 20
_LANES = 4
_ROW = "path long, depth long, length long, bytes long, prefix binary, part int"


def turns(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The turns as ``conv, at`` (from 0)``, digest, bytes``, and the conversations as ``conv, length``.

    Turns ascend, NULL first; turns of one number ascend by their digest. NULL role or text is
    empty. Rows without a conversation belong to none. Positions come from range partitions, so a
    conversation may have any number of turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    read = table.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = surrogate_key(read, ["conv", "turn", "digest"], "place")
    convs = materialize(placed.groupBy("conv").agg(F.min("place").alias("first"), F.count("*").alias("length")), "conversations")
    first = convs.select(F.col("conv").alias("of"), "first")
    numbered = placed.join(first, F.col("conv") == F.col("of")).select("conv", (F.col("place") - F.col("first")).alias("at"), "digest", "bytes")
    return materialize(numbered, "turns"), convs.select("conv", "length")


def rebuilt(said: DataFrame, convs: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: ``path, depth`` (from 1)``, length, digest, bytes`` and ``path, length``.

    Of conversation c the first ``h`` turns are those of ``c - c % family``, all if it has fewer,
    none if there is no such conversation; c's own turns after its first ``h`` follow.
    ``h`` is crc32 of the decimal id modulo ``shared + 1``.
    """
    base = F.col("conv") - F.col("conv") % family
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (shared + 1)
    first = convs.select(F.col("conv").alias("base_conv"), F.col("length").alias("base_length"))
    borrowed = F.least("h", F.coalesce("base_length", F.lit(0)))
    paths = (
        convs.withColumn("base", base).withColumn("h", h)
        .join(first, F.col("base") == F.col("base_conv"), "left")
        .select("conv", "base", "h", borrowed.alias("borrowed"), (borrowed + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("path_length"))
    )
    paths = materialize(paths.withColumnRenamed("conv", "path"), "paths")
    own = said.join(paths, (F.col("conv") == F.col("path")) & (F.col("at") >= F.col("h"))).withColumn(
        "depth", F.col("at") - F.col("h") + F.col("borrowed") + 1
    )
    lent = said.filter(F.col("at") < shared).join(paths, (F.col("conv") == F.col("base")) & (F.col("at") < F.col("h"))).withColumn(
        "depth", F.col("at") + 1
    )
    columns = ["path", "depth", F.col("path_length").alias("length"), "digest", "bytes"]
    return own.select(columns).unionByName(lent.select(columns)), paths.select("path", F.col("path_length").alias("length"))


def _lanes(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<u8").reshape(-1, _LANES)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of digests along each path, from where the path begins in this partition."""
    part = TaskContext.get().partitionId()
    last, carried = None, np.zeros(_LANES, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").to_numpy()
        sums = np.cumsum(_lanes(batch.column("digest").to_pylist()), axis=0, dtype=np.uint64)
        begins = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        before = np.zeros((len(begins), _LANES), np.uint64)
        before[1:] = sums[begins[1:] - 1]
        if path[0] == last:
            before[0] -= carried
        sums -= np.repeat(before, np.diff(np.r_[begins, len(path)]), axis=0)
        last, carried = path[-1], sums[-1].copy()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("path", "depth", "length", "bytes")), pa.array([r.tobytes() for r in sums], pa.binary()), pa.array(np.full(len(path), part, np.int32))],
            names=["path", "depth", "length", "bytes", "prefix", "part"],
        )


def _prefixes(steps: DataFrame) -> DataFrame:
    """Each step with the digest of its path so far: ``path, depth, length, bytes, prefix``.

    A prefix is the sum, in four lanes of 64 bits, of the digests of its turns, each taken with its
    position: equal prefixes have equal sums, and others differ but for a chance of 2**-256 a
    pair. Sums run within range partitions; a path that goes on in another partition gets the sum of the parts before,
    of which there is one a partition at most, so that a path may have any length.
    """
    placed = F.unhex(F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")).cast("binary"), 256))
    sorted_steps = (
        steps.select("path", "depth", "length", "bytes", placed.alias("digest"))
        .repartitionByRange("path", "depth").sortWithinPartitions("path", "depth")
    )
    found = materialize(sorted_steps.mapInArrow(_running, _ROW), "prefixes")
    segments = found.groupBy("part", "path").agg(F.min("depth").alias("from"), F.max_by("prefix", "depth").alias("sum"))
    segments = materialize(segments, "segments")
    cut = segments.filter(F.col("from") > 1).select("path").distinct()
    carried: dict[int, tuple[int, np.ndarray]] = {}
    last, total = None, np.zeros(_LANES, np.uint64)
    # Two rows a partition at most.
    for r in segments.join(cut, "path", "left_semi").orderBy("path", "from").collect():
        if r["path"] != last:
            last, total = r["path"], np.zeros(_LANES, np.uint64)
        if r["from"] > 1:
            carried[r["part"]] = (last, total)
        total = total + _lanes([bytes(r["sum"])])[0]
    if not carried:
        return found.drop("part")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, prefix = batch.column("path").to_pylist(), batch.column("prefix").to_pylist()
            for i, part in enumerate(batch.column("part").to_pylist()):
                of, before = carried.get(part, (None, None))
                if path[i] == of:
                    prefix[i] = (_lanes([prefix[i]])[0] + before).tobytes()
            yield batch.set_column(batch.schema.get_field_index("prefix"), "prefix", pa.array(prefix, pa.binary()))

    return materialize(found.mapInArrow(add, _ROW), "whole-prefixes").drop("part")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``owner, depth, first, piece``: ids of a node in order, joined by commas, cut beyond a size."""
    node, ids, size = None, [], 0
    for batch in batches:
        for owner, depth, path in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "path"))):
            if ids and ((owner, depth) != node or size >= _PIECE):
                yield *node, ids[0], ",".join(map(str, ids)).encode()
                ids, size = [], 0
            node = owner, depth
            ids.append(path)
            size += 20
    if ids:
        yield *node, ids[0], ",".join(map(str, ids)).encode()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``owner, depth, ends_sha256`` of pieces that come in order; only the state of one hash is held."""
    node, digest = None, None
    for batch in batches:
        for owner, depth, piece in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "piece"))):
            if (owner, depth) != node:
                if node is not None:
                    yield *node, digest.hexdigest()
                node, digest = (owner, depth), sha256(piece)
            else:
                digest.update(b"," + piece)
    if node is not None:
        yield *node, digest.hexdigest()


def _streamed(df: DataFrame, rows, schema: str, chunk: int) -> DataFrame:
    names, types = arrow_types(df, schema)
    return df.mapInArrow(lambda batches: batched(rows(batches), names, types, chunk), schema)


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of ``owner, depth, path`` per node, joined by commas.

    Ids are sorted in range partitions, which cut a node of any size, and leave them as pieces of a
    megabyte; only the pieces of a node meet in a task, which reads them one after the other.
    """
    cut = ends.repartitionByRange("owner", "depth", "path").sortWithinPartitions("owner", "depth", "path")
    pieces = _streamed(cut, _joined_ids, "owner long, depth long, first long, piece binary", 64)
    together = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return _streamed(together, _hashed, "owner long, depth long, ends_sha256 string", 10_000)


def prefix_trie(steps: DataFrame, paths: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per distinct beginning of the paths, with sums over all that begin so.

    ``steps`` has ``path, depth`` (1 to length)``, length, digest, bytes``, one row a turn, and ``paths``
    has ``path, length``, also those without turns. A node is named by its smallest member
    and its depth: ``id, depth, parent_id`` (NULL of the root)``, n_convs`` (members)``, n_children, n_leaves``
    (nodes without children in its subtree)``, saved_tokens`` (over its subtree, (members - 1) times
    the bytes of the node's last text)``, ends_sha256`` (of the members that end here). No paths give no rows.

    Members are counted with partial sums; sums over subtrees come from ``subtree_sums``.
    """
    found = _prefixes(steps)
    nodes = materialize(
        found.groupBy("prefix", "depth").agg(
            F.min("path").alias("owner"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("mass"),
        ),
        "trie-nodes",
    )
    at = found.select("path", "depth", "length", "prefix").join(nodes.select("prefix", "owner"), "prefix").drop("prefix")
    top = paths.agg(
        F.min("path").alias("owner"), F.lit(0).cast("long").alias("depth"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("bytes"),
        F.sum(F.col("length") + 1).alias("mass"),
    ).filter(F.col("owner").isNotNull())
    top = materialize(top, "trie-root")
    root = top.first()
    root_owner = root["owner"] if root else None
    at = materialize(at, "trie-steps")
    before = at.select(F.col("path").alias("p"), (F.col("depth") + 1).alias("d"), F.col("owner").alias("parent"))
    linked = at.join(before, (F.col("path") == F.col("p")) & (F.col("depth") == F.col("d")), "left").select(
        "path", "depth", "length", "owner", F.when(F.col("depth") == 1, F.lit(root_owner)).otherwise(F.col("parent")).alias("parent")
    )
    linked = materialize(linked, "trie-links")
    parents = linked.filter(F.col("path") == F.col("owner")).select("owner", "depth", "parent")
    every = nodes.drop("prefix").join(parents, ["owner", "depth"]).unionByName(
        top.withColumn("parent", F.lit(None).cast("long"))
    )
    children = parents.groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    every = materialize(every.join(children, ["owner", "depth"], "left").fillna(0, ["n_children"]), "trie")
    values = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    sums = subtree_sums(every.select("owner", "depth", "mass", *_named(values)), linked, list(values))
    ends = linked.filter(F.col("depth") == F.col("length")).select("owner", "depth", "path").unionByName(
        paths.filter("length = 0").select(F.lit(root_owner).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "path")
    )
    return (
        every.join(sums, ["owner", "depth"]).join(_end_digests(ends), ["owner", "depth"], "left")
        .select(
            F.col("owner").alias(id_col), "depth", F.col("parent").alias(f"parent_{id_col}"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _named(values: dict[str, Column]) -> list[Column]:
    return [v.alias(k) for k, v in values.items()]


def conversation_trie(table: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The trie of the conversations of ``conv_id, turn, role, text``, rebuilt in families.

    Rows without a conversation count for none; repeated rows are turns of their own; other columns are ignored;
    an empty table gives no rows.
    """
    return prefix_trie(*rebuilt(*turns(table, conv_col)), conv_col)
