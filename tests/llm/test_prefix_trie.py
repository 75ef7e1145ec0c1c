"""The trie of conversations and its rollup against plain Python."""

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from crispstar.llm import centroid, prefix_trie
from crispstar.session import materialize
from tests.conftest import final_plan

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int, owner string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def original(table):
    convs = defaultdict(list)
    for c, turn, role, text in table:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [x[3] for x in sorted(said, key=lambda x: x[:3])] for c, said in convs.items()}


def brute(table):
    own, rebuilt = original(table), {}
    for c, said in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = own.get(base, [])[:h] + said[h:]
    members = defaultdict(list)
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    out = Counter()
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out[min(cs), len(p), up, len(cs), children[p], leaves[p], saved[p], sha256(ends.encode()).hexdigest()] += 1
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "x") for r in rows], SCHEMA)


def got(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


AWKWARD = [
    (0, None, None, None), (0, 1, "user", "hi"), (0, 2, "bot", "é" * 9), (1, 1, "user", "hi"), (1, 1, "user", "hi"), (2, 3, "", "a"), (2, 3, "", "b"),
    (5, 1, "user", "hi"), (6, 0, "user", "x"), (7, 0, "user", "hi"), (None, 1, "user", "lost"), (-3, 1, "user", "hi"), (11, 1, None, None), (9, 4, "a", "bc"), (9, 5, "ab", "c"),
    (10, 0, "user", "long " * 30_000),
]


def test_awkward_rows(spark):
    assert got(prefix_trie.conversation_trie(table(spark, AWKWARD).repartition(3))) == brute(AWKWARD)


def random_table(seed, n=150):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.permutation(n):
        for t in range(rng.integers(1, 14)):
            rows.append((int(c), t, "user" if t % 2 else "bot", f"w{rng.integers(0, 2)}" if t < 9 else "same"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    rows = random_table(seed)
    assert got(prefix_trie.conversation_trie(table(spark, rows).repartition(4))) == brute(rows)


@pytest.mark.parametrize("piece", [1, 30])
def test_distributed_rounds(spark, monkeypatch, piece):
    """Components are split in Spark down to single nodes, also a long chain and a node with many children."""
    rows = [*random_table(3, 12), *((100, t, "user", f"t{t}") for t in range(60)), *((i, 0, "user", f"only {i}") for i in range(200, 230))]
    whole = centroid.subtree_sums
    monkeypatch.setattr(prefix_trie, "subtree_sums", lambda n, s, v: whole(n, s, v, piece))
    assert got(prefix_trie.conversation_trie(table(spark, rows).repartition(4))) == brute(rows)


def test_one_conversation_over_many_partitions(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(3, t, "user", f"t{t % 7}") for t in range(400)] + [(c, 0, "user", "t0") for c in range(10, 30)]
    assert got(prefix_trie.conversation_trie(table(spark, rows).repartition(6))) == brute(rows)


def test_centroids_halve_a_component():
    rng = np.random.default_rng(0)
    for shape in ("chain", "star", "random"):
        n = 500
        parents = [-1] + [i - 1 if shape == "chain" else 0 if shape == "star" else int(rng.integers(0, i)) for i in range(1, n)]
        weights, values = rng.integers(1, 9, n).tolist(), rng.integers(0, 99, n).tolist()
        mass, want = weights[:], values[:]
        for i in range(n - 1, 0, -1):
            mass[parents[i]] += mass[i]
            want[parents[i]] += want[i]
        assert centroid.split_component(parents, mass, [values, [1] * n])[0] == want


def test_pieces_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_PIECE", 100)
    ends = spark.range(3000, numPartitions=5).select((F.col("id") * 7 % 3000).alias("path"), F.lit(0).cast("long").alias("owner"), F.lit(2).cast("long").alias("depth"))
    made = prefix_trie._end_digests(ends).collect()
    assert [r["ends_sha256"] for r in made] == [sha256(",".join(map(str, range(3000))).encode()).hexdigest()]


def test_no_rows(spark):
    made = prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert made.columns == COLUMNS and made.count() == 0


def test_joins_can_be_split(spark):
    rows = materialize(table(spark, random_table(4)), "conversations")
    text = final_plan(prefix_trie.conversation_trie(rows))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
