"""A Merkle manifest of a table: built levels stored as parent-linked node rows, proofs climbed by a recursive query.

A tree per group and one over the groups' roots. Digests are SHA-256 over the lowercase
hex text of what they cover, kept as 32 bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crispstar.llm.common import in_arrow
from crispstar.operators.keys import surrogate_key
from crispstar.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels between a stored node and the stored node that it links to: a block has 2**STEP nodes at most.
STEP = 10
_TOP = 0  # number of the tree over the groups; those of the groups start at 1

_NODE = (
    "top boolean, tree long, stage int, pos long, n long, hash binary, id long, presented binary,"
    " sides string, siblings binary, up_tree long, up_stage int, up_pos long"
)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Iterable[Column]) -> Column:
    """The digest of a row with these values."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def parent(children: list[bytes]) -> bytes:
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def climb_block(hashes: list[bytes], levels: int) -> tuple[bytes, list[str], list[bytes]]:
    """What stands ``levels`` above some consecutive nodes, and each node's way there.

    A way is a letter per level, telling where the sibling stands (``l``, ``r``, or ``n``
    for none), and the siblings that there are, put together.
    """
    row, built = hashes, []
    for _ in range(levels):
        built.append(row)
        row = [parent(row[i : i + 2]) for i in range(0, len(row), 2)]
    sides, siblings = [], []
    for i in range(len(hashes)):
        way, beside = [], []
        for level in built:
            other = i ^ 1
            if other < len(level):
                way.append("l" if other < i else "r")
                beside.append(level[other])
            else:
                way.append("n")
            i >>= 1
        sides.append("".join(way))
        siblings.append(b"".join(beside))
    return row[0], sides, siblings


def _stage(frontier: DataFrame, stage: int, final: bool, step: int) -> DataFrame:
    """The stored nodes of a stage, ``top`` false, with what the next stage begins with, ``top`` true.

    ``frontier`` has ``tree, pos, n, hash, id, presented``, with ``n`` the nodes of the tree at
    this level. A block of consecutive positions, bounded by ``step``, is a group. A tree with
    one block ends here: it links to the tree over the groups, or to nothing if it is ``final``.
    """
    block = F.shiftright("pos", step).alias("block")
    blocks = frontier.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "id", "presented"))).alias("held"))

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for tree, n, at, held in zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "block", "held"))):
            ends = n <= 1 << step
            above, sides, siblings = climb_block([x["hash"] for x in held], (n - 1).bit_length() if ends else step)
            up = (tree, stage + 1, at) if not ends else (None, None, None) if final else (_TOP, 0, tree - 1)
            for x, way, beside in zip(held, sides, siblings):
                yield False, tree, stage, x["pos"], n, x["hash"], x["id"], x["presented"], way, beside, *up
            yield True, tree, stage, at, -(-n >> step) if not ends else 0, above, None, None, None, None, *up

    return materialize(in_arrow(blocks, rows, _NODE, 4000), f"nodes-{stage}")


def _tree(frontier: DataFrame, largest: int, final: bool, step: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored nodes by stage, and the root of each tree: ``tree, hash``."""
    stored, roots = [], []
    while True:
        written = _stage(frontier, len(stored), final, step)
        stored.append(written.filter("not top"))
        roots.append(written.filter("top and n = 0").select("tree", "hash"))
        if largest <= 1 << step:
            break
        largest = -(-largest >> step)
        frontier = written.filter("top and n > 0").select("tree", "pos", "n", "hash", "id", "presented")
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return stored, every


@dataclass
class Manifest:
    """Node rows of the leaves and of all above them, the root of each group's tree, and the root of all."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def build(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
    presented: dict[str, Column] | None = None, where: Column | None = None, step: int = STEP,
) -> Manifest:
    """Build the trees and store their nodes.

    Leaves of a group ascend by id, NULL first, ties by digest; groups ascend bytewise, NULL
    first. Neighbours pair up, a last one without neighbour alone, until one is left. For rows
    ``where``, the digest of the row with other values (``presented``) is kept beside
    the leaf, to be verified against the tree.

    Positions come from range partitions, so a group of any size, or rows repeated any number
    of times, spread over tasks; a task builds ``step`` levels above a block.
    """
    spark = docs.sparkSession
    changed = [(presented or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(
        F.col(group_col).cast("string").alias("grp"),
        F.col(id_col).cast("long").alias("id"),
        leaf(F.col(c) for c in fields).alias("hash"),
        (F.when(where, leaf(changed)) if where is not None else F.lit(None).cast("binary")).alias("presented"),
    )
    placed = surrogate_key(leaves, ["grp", "id", "hash"], "place")
    counted = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = materialize(surrogate_key(counted, ["grp"], "tree", unique_rows=True).withColumnRenamed("grp", "of"), "groups")
    largest, trees = groups.agg(F.max("n"), F.count("*")).first()
    frontier = placed.join(groups, F.col("grp").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("place") - F.col("first")).alias("pos"), "n", "hash", "id", "presented"
    )
    below, subroots = _tree(frontier, largest or 0, False, step)
    tops = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), (F.col("tree") - 1).alias("pos"), F.lit(trees).cast("long").alias("n"), "hash",
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("presented"),
    )
    above, roots = _tree(tops, trees, True, step)
    nodes = above[0]
    for more in [*above[1:], *below[1:]]:
        nodes = nodes.unionByName(more)
    found = roots.first()
    return Manifest(below[0], nodes, subroots, found["hash"].hex() if found else None)


def _folded(start: str, sides: str, siblings: str) -> str:
    """SQL for the digest that a way leads to from ``start``."""
    digest = "unhex(sha2(lower(hex({})), 256))"
    beside = f"substring({siblings}, a.at, 32)"
    left, right, none = (digest.format(x) for x in (f"concat({beside}, a.h)", f"concat(a.h, {beside})", "a.h"))
    return f"""if(length({sides}) = 0, {start}, aggregate(sequence(1, length({sides})), named_struct('h', {start}, 'at', 1),
        (a, i) -> CASE substring({sides}, i, 1)
            WHEN 'l' THEN named_struct('h', {left}, 'at', a.at + 32)
            WHEN 'r' THEN named_struct('h', {right}, 'at', a.at + 32)
            ELSE named_struct('h', {none}, 'at', a.at) END, a -> a.h))"""


@contextmanager
def _no_row_limit(spark: SparkSession) -> Iterator[None]:
    """Recursive queries without a bound on their rows; the bound on their depth stays."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def climb(manifest: Manifest) -> DataFrame:
    """Every leaf's way to the root: ``id, tree, leaf, folded, siblings``.

    A recursive query: each round joins the rows that are still below the root with the node
    that they link to, appends its siblings and folds the presented digest on. A round climbs
    ``STEP`` levels, and the rows above the leaves are fewer by 2**STEP, so the depth
    is the logarithm to that base of the largest group, and once more for the groups.
    """
    spark = manifest.leaves.sparkSession
    with _no_row_limit(spark):
        return materialize(
            spark.sql(
                f"""WITH RECURSIVE climbing (id, tree, leaf, folded, siblings, up_tree, up_stage, up_pos) AS (
                    SELECT id, tree, hash, {_folded("coalesce(presented, hash)", "sides", "siblings")}, siblings, up_tree, up_stage, up_pos
                    FROM {{leaves}}
                    UNION ALL
                    SELECT c.id, c.tree, c.leaf, {_folded("c.folded", "n.sides", "n.siblings")}, concat(c.siblings, n.siblings),
                           n.up_tree, n.up_stage, n.up_pos
                    FROM climbing c JOIN {{nodes}} n ON c.up_tree = n.tree AND c.up_stage = n.stage AND c.up_pos = n.pos
                )
                SELECT id, tree, leaf, folded, siblings FROM climbing WHERE up_tree IS NULL""",
                leaves=manifest.leaves,
                nodes=manifest.nodes,
            ),
            "climbed",
        )


def verified(manifest: Manifest, id_col: str = "doc_id") -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, digests as lowercase hex.

    The proof is the siblings from leaf to root; ``folded_root`` is what the presented
    digest, else the leaf, leads to with them, ``verified`` whether that is the root. NULL values, empty and
    long texts are leaves like any other, repeated rows leaves of their own; columns other than the
    fields are ignored. An empty table has no root and gives no rows.
    """
    subroots = manifest.subroots.withColumnRenamed("hash", "subroot")
    root = F.lit(manifest.root).cast("string")
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "folded", "siblings")}
    return climb(manifest).join(subroots, "tree").select(
        F.col("id").alias(id_col),
        text["leaf"].alias("leaf"),
        text["subroot"].alias("subroot"),
        root.alias("root"),
        F.sha2(text["siblings"].cast("binary"), 256).alias("proof_sha256"),
        text["folded"].alias("folded_root"),
        (text["folded"] == root).alias("verified"),
    )


def store(manifest: Manifest, path: str) -> None:
    """Write a manifest as tables below ``path``: the nodes of the leaves and above, and the roots."""
    manifest.leaves.write.parquet(f"{path}/leaves")
    manifest.nodes.write.parquet(f"{path}/nodes")
    root = F.lit(None).cast("binary") if manifest.root is None else F.unhex(F.lit(manifest.root))
    spark = manifest.leaves.sparkSession
    top = spark.range(1).select(F.lit(_TOP).cast("long").alias("tree"), root.alias("hash"))
    manifest.subroots.unionByName(top).write.parquet(f"{path}/roots")


def load(spark: SparkSession, path: str) -> Manifest:
    """A manifest that ``store`` has written."""
    roots = spark.read.parquet(f"{path}/roots")
    top = roots.filter(F.col("tree") == _TOP).first()["hash"]
    leaves, nodes = (spark.read.parquet(f"{path}/{x}") for x in ("leaves", "nodes"))
    return Manifest(leaves, nodes, roots.filter(F.col("tree") != _TOP), top.hex() if top else None)


def presenting(manifest: Manifest, docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id") -> Manifest:
    """The manifest with the digests of ``docs`` as they are now presented, to be ``verified``.

    Rows meet their leaf by id, so no id may repeat in ``docs``; those that the manifest does not know
    are left out, and so are leaves without a row, which ``verified`` then does not list.
    """
    now = materialize(docs.select(F.col(id_col).cast("long").alias("now_id"), leaf(F.col(c) for c in fields).alias("now")), "presented")
    if not now.groupBy("now_id").count().filter("count > 1").isEmpty():
        raise ValueError(f"{id_col} repeats")
    met = manifest.leaves.drop("presented").join(now, F.col("id").eqNullSafe(F.col("now_id")))
    return Manifest(met.withColumnRenamed("now", "presented").select(manifest.leaves.columns), manifest.nodes, manifest.subroots, manifest.root)


def tampered_manifest(docs: DataFrame, id_col: str = "doc_id", length_col: str = "n_chars") -> DataFrame:
    """``verified`` over ``docs``, where one id in seven, by crc32, is presented with a length one too large."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 0
    return verified(build(docs, presented={length_col: F.try_add(F.col(length_col), F.lit(1))}, where=hit, id_col=id_col), id_col)
