"""The Merkle manifest against plain Python."""

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from crispstar.llm import merkle
from tests.conftest import final_plan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, tree int, hash string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def packed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def row_hash(r, more=0):
    i, text, lang, source, n = r
    return h(*map(packed, (i, source, lang, None if n is None else n + more, text)))


def levels(row):
    out = [row]
    while len(row) > 1:
        row = [h(*row[i : i + 2]) for i in range(0, len(row), 2)]
        out.append(row)
    return out


def ways(built, at):
    """Siblings and, for folding, whether each stands to the left."""
    for row in built[:-1]:
        other = at ^ 1
        yield (row[other], other < at) if other < len(row) else (None, False)
        at //= 2


def brute(table):
    groups = defaultdict(list)
    for r in table:
        groups[r[2]].append((r[0] is not None, r[0] or 0, row_hash(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    top = levels([t[-1][0] for t in trees])
    out = Counter()
    for at, (g, tree) in enumerate(zip(order, trees)):
        for pos, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            hit = r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0
            folded, proof = row_hash(r, 1) if hit else leaf, ""
            for sibling, left in [*ways(tree, pos), *ways(top, at)]:
                proof += sibling or ""
                folded = h(folded) if sibling is None else h(sibling, folded) if left else h(folded, sibling)
            root = top[-1][0]
            out[r[0], leaf, tree[-1][0], root, h(proof), folded, folded == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
AWKWARD = [
    (1, "a", "en", "s", 1), (2, None, None, None, None), (None, "", None, "s", 0), (None, "", None, "s", 0), (3, "é ü", "de", "", 3),
    (4, "x" * 200_000, "en", "s", 200_000), (4, "x", "en", "s", 1), (4, "x", "en", "s", 1), (5, "y", "", "s", 1), (-7, "z", "en", None, 1), (1 << 62, "z", "ä", None, 1),
]


def got(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "clash") for r in rows], SCHEMA)


def test_awkward_rows(spark):
    assert got(merkle.tampered_manifest(table(spark, AWKWARD).repartition(3))) == brute(AWKWARD)


@pytest.mark.parametrize("step", [1, 2, 3])
@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 33])
def test_any_number_of_leaves_and_levels(spark, step, n):
    rows = [(i, f"t{i}", f"l{i * i % 5}" if i % 11 else None, "s", i) for i in range(n)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    built = merkle.build(table(spark, rows).repartition(4), presented={"n_chars": F.col("n_chars") + 1}, where=hit, step=step)
    assert got(merkle.verified(built)) == brute(rows)


def test_one_group_of_many_blocks(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(2500)]
    assert got(merkle.tampered_manifest(table(spark, rows).repartition(5))) == brute(rows)


def test_no_rows(spark):
    made = merkle.tampered_manifest(spark.createDataFrame([], SCHEMA))
    assert made.columns == COLUMNS and made.count() == 0


def test_row_limit_of_recursive_queries_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    merkle.tampered_manifest(table(spark, AWKWARD)).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_copies_spread_over_blocks(spark, settings):
    """5,000 equal rows without an id: no task holds them all."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    copies = spark.range(5000, numPartitions=5).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars")
    )
    built = merkle.build(copies, step=6)
    in_block = built.leaves.groupBy(F.shiftright("pos", 6)).count().agg(F.max("count")).first()[0]
    assert in_block == 64 and built.leaves.count() == 5000
    made = merkle.verified(built)
    assert made.filter("verified").count() == 5000 and "CartesianProduct" not in final_plan(made)


def test_a_stored_manifest_tells_what_has_changed(spark, tmp_path):
    rows = [(i, f"t{i}", f"l{i % 3}", "s", i) for i in range(200)]
    path = str(tmp_path / "manifest")
    merkle.store(merkle.build(table(spark, rows), step=3), path)
    kept = merkle.load(spark, path)
    assert kept.root == next(iter(brute(rows)))[3]
    now = [(i, t + ("!" if i % 20 == 0 else ""), g, s, n) for i, t, g, s, n in rows if i != 7] + [(999, "new", "l0", "s", 1)]
    found = merkle.verified(merkle.presenting(kept, table(spark, now))).collect()
    assert {r.doc_id: r.verified for r in found} == {i: i % 20 != 0 for i in range(200) if i != 7}
    with pytest.raises(ValueError, match="repeats"):
        merkle.presenting(kept, table(spark, [*now, now[0]]))
    empty = str(tmp_path / "empty")
    merkle.store(merkle.build(spark.createDataFrame([], SCHEMA)), empty)
    assert merkle.load(spark, empty).root is None and merkle.verified(merkle.load(spark, empty)).count() == 0
