"""Sums over the subtrees of a tree of paths by centroid decomposition."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.llm.common import arrow_types, batched
from crispstar.session import materialize

# Components of at most this mass, hence of at most so many nodes, are finished within a task.
PIECE = 4096


def split_component(parents: list[int], masses: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of each of ``values`` in one component, whose first node is its top.

    A node has its parent's place, before its own, and the mass of its subtree, where each node weighs 1
    or more. The centroid is the deepest node with over half of the mass below it: what hangs on
    it, and what is left above, has half of the mass at most. The parts below are settled first; the
    centroid's total is added along the path from it to the top; then the rest above is split in the same way.
    """
    children: list[list[int]] = [[] for _ in parents]
    for i, p in enumerate(parents[1:], 1):
        children[p].append(i)
    mass, sums = list(masses), [[0] * len(parents) for _ in values]
    gone = [False] * len(parents)

    def settle(top: int) -> list[int]:
        """The totals of the component below ``top``."""
        totals = [0] * len(values)
        while True:
            path, half = [top], mass[top] / 2
            while True:
                children[path[-1]] = under = [c for c in children[path[-1]] if not gone[c]]
                heavy = next((c for c in under if mass[c] > half), None)
                if heavy is None:
                    break
                path.append(heavy)
            centroid, below = path[-1], [v[path[-1]] for v in values]
            for c in children[centroid]:
                for k, x in enumerate(settle(c)):
                    below[k] += x
            for node in path:
                for k, x in enumerate(below):
                    sums[k][node] += x
            gone[centroid] = True
            totals = [a + b for a, b in zip(totals, below)]
            if centroid == top:
                return totals
            for node in path[:-1]:
                mass[node] -= mass[centroid]

    settle(0)
    return sums


def _small(names: list[str]):
    """Components that arrive one after the other, each from its top downwards."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in batches:
            columns = ["comp_owner", "comp_depth", "owner", "depth", "parent", "mass", *names, *(f"{n}_sum" for n in names)]
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if held and held[0][:2] != row[:2]:
                    yield from _settled(held, len(names))
                    held = []
                held.append(row)
        if held:
            yield from _settled(held, len(names))

    return rows


def _settled(held: list[tuple], n: int) -> Iterator[tuple]:
    if len(held) == 1:
        row = held[0]
        yield row[2], row[3], *(a + b for a, b in zip(row[6 : 6 + n], row[6 + n :]))
        return
    place = {r[2:4]: i for i, r in enumerate(held)}
    parents = [-1, *(place[r[4], r[3] - 1] for r in held[1:])]
    sums = split_component(parents, [r[5] for r in held], [[r[6 + k] for r in held] for k in range(n)])
    for i, r in enumerate(held):
        yield r[2], r[3], *(sums[k][i] + r[6 + n + k] for k in range(n))


def subtree_sums(nodes: DataFrame, links: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """``owner, depth`` and, for each of ``values``, its sum over the node's subtree.

    ``nodes`` has ``owner, depth, mass`` and the values; ``mass`` is the weight of a node's subtree, where each node weighs
    1 or more. ``links`` has the nodes on each path, ``path, depth, owner, parent``, from
    depth 1; node (owner, depth) lies on the path ``owner``, and the one node of depth 0 is the top.

    Each round splits all components with a mass over ``piece`` at their centroid. The nodes with over half of
    a component's mass are one path from its top, and the last of it is the centroid; what
    hangs there takes the name of the child it hangs on, read from the path of each node. Totals of
    the parts are summed per component and added to the nodes of that path. Masses halve, so there are as many rounds as
    the total has bits beyond ``piece``. A component within ``piece`` is settled in a task, in the same way.
    """
    sums = [f"{v}_sum" for v in values]
    zero = F.lit(0).cast("long")
    parent = links.filter(F.col("path") == F.col("owner")).select("owner", "depth", "parent")
    top = nodes.filter("depth = 0").agg(F.min("owner"), F.max("mass")).first()
    state = nodes.join(parent, ["owner", "depth"], "left").withColumns(
        {"comp_owner": F.lit(top[0]).cast("long"), "comp_depth": zero, "total": F.lit(top[1]).cast("long"), **{s: zero for s in sums}}
    )
    columns = ["owner", "depth", "parent", "mass", "comp_owner", "comp_depth", "total", *values, *sums]
    comp = ["comp_owner", "comp_depth"]
    state = materialize(state.select(columns), "components")
    small, done = [state.filter(F.col("total") <= piece)], []
    on_path = F.col("path").alias("on_path"), F.col("depth").alias("on_depth"), F.col("owner").alias("child"), F.col("parent").alias("child_of")
    while (big := state.filter(F.col("total") > piece)).limit(1).count():
        # The path with over half of the mass, from which one row per component is left.
        heavy = big.filter(F.col("mass") * 2 > F.col("total"))
        centroids = materialize(
            heavy.groupBy(*comp).agg(F.min_by(F.struct("owner", "depth", "mass"), "mass").alias("c")).select(
                *[F.col(x).alias(f"of_{x}") for x in comp], F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"), F.col("c.mass").alias("c_mass")
            ),
            "centroids",
        )
        asked = big.join(centroids, reduce(lambda a, b: a & b, [F.col(x) == F.col(f"of_{x}") for x in comp]))
        below = (F.col("depth") > F.col("c_depth")) & F.col("child_of").eqNullSafe(F.col("c_owner"))
        is_centroid = (F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth"))
        seen = asked.join(links.select(*on_path), (F.col("owner") == F.col("on_path")) & (F.col("c_depth") + 1 == F.col("on_depth")), "left")
        place = F.when(is_centroid, "centroid").when(below, "below").when(F.col("mass") * 2 > F.col("total"), "path").otherwise("beside")
        placed = materialize(seen.withColumn("place", place).select(*columns, "c_mass", "c_depth", "child", "place"), "placed")

        under = F.col("place").isin("centroid", "below")
        totals = placed.groupBy(*comp).agg(*[F.sum(F.when(under, F.col(v))).alias(f"add_{v}") for v in values])
        totals = materialize(totals.select(*[F.col(x).alias(f"of_{x}") for x in comp], *[f"add_{v}" for v in values]), "totals")
        above = placed.filter(F.col("place").isin("centroid", "path")).join(totals, reduce(lambda a, b: a & b, [F.col(x) == F.col(f"of_{x}") for x in comp]))
        above = above.withColumns({s: F.col(s) + F.col(f"add_{v}") for v, s in zip(values, sums)})
        done.append(above.filter("place = 'centroid'").select("owner", "depth", *[F.col(s).alias(v) for v, s in zip(values, sums)]))
        lighter = {"total": F.col("total") - F.col("c_mass")}
        kept = above.filter("place = 'path'").withColumns({"mass": F.col("mass") - F.col("c_mass"), **lighter}).select(columns).unionByName(
            placed.filter("place = 'beside'").withColumns(lighter).select(columns)
        )
        hung = placed.filter("place = 'below'").withColumns({"comp_owner": F.col("child"), "comp_depth": F.col("c_depth") + 1})
        weights = materialize(hung.filter(F.col("depth") == F.col("comp_depth")).select(F.col("owner").alias("w_owner"), F.col("depth").alias("w_depth"), F.col("mass").alias("weight")), "weights")
        hung = hung.join(weights, (F.col("comp_owner") == F.col("w_owner")) & (F.col("comp_depth") == F.col("w_depth"))).withColumn("total", F.col("weight"))
        state = materialize(kept.unionByName(hung.select(columns)), "components")
        small.append(state.filter(F.col("total") <= piece))

    schema = ", ".join(["owner long", "depth long", *[f"`{v}` long" for v in values]])
    names, types = arrow_types(nodes, schema)
    rows = _small(values)
    left = reduce(DataFrame.unionByName, small).repartition(*comp).sortWithinPartitions(*comp, "depth")
    settled = left.mapInArrow(lambda batches: batched(rows(batches), names, types), schema)
    return reduce(DataFrame.unionByName, [settled, *done])
