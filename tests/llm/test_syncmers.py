"""Closed syncmer fingerprints against plain Python."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from crispstar.llm import syncmers

SCHEMA = "doc_id long, text string, lang string, part int, look int, key string, id int"
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
MASK = (1 << 64) - 1


def rolled(points):
    h = 0
    for p in points:
        h = (h * 0x9E3779B97F4A7C15 + p + 1) & MASK
    h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & MASK
    return h ^ (h >> 29)


def brute_anchors(text, k, s):
    """By definition: the smallest inner hash is the first or the last."""
    points, out = [ord(c) for c in text], []
    for i in range(len(text) - k + 1):
        inner = [rolled(points[j : j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            h = rolled(points[i : i + k])
            if not out or out[-1][1] != h:
                out.append((i, h))
    return out


def brute_likeness(a, b):
    a, b = a.tolist(), b.tolist()
    if not a or not b:
        return float(len(a) == len(b))
    head = tail = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    where = defaultdict(list)
    for i, v in enumerate(y):
        where[v].append(i)
    met = [where[v].pop(0) for v in x if where[v]]
    best = [1] * len(met)
    for i in range(len(met)):
        best[i] += max((best[j] for j in range(i) if met[j] < met[i]), default=0)
    return 2 * (head + tail + max(best, default=0)) / (len(a) + len(b))


def text_of(rng, n, letters="abcdefgh é漢𝄞"):
    return "".join(rng.choice(list(letters), n))


@pytest.mark.parametrize("k,s", [(32, 8), (7, 3), (5, 1), (12, 11)])
def test_anchors_by_definition(k, s):
    rng = np.random.default_rng(k)
    texts = ["", "a", "a" * 60, "ab" * 40, *(text_of(rng, int(n)) for n in rng.integers(1, 150, 20)), text_of(rng, 400, "ab")]
    for text, (at, hashes) in zip(texts, syncmers.closed_syncmers(texts, k, s)):
        want = brute_anchors(text, k, s)
        if want or not text:
            assert list(zip(at.tolist(), hashes.tolist())) == want
        else:
            assert at.tolist() == [0] and len(hashes) == 1


def test_anchors_do_not_depend_on_their_surroundings():
    rng = np.random.default_rng(5)
    a, b, c = (text_of(rng, 500) for _ in range(3))
    alone = dict(zip(*(x.tolist() for x in syncmers.closed_syncmers([b])[0])))
    within = dict(zip(*(x.tolist() for x in syncmers.closed_syncmers([a + b + c])[0])))
    assert len(alone) > 20 and all(within.get(at + 500) == h for at, h in alone.items())


def test_likeness():
    rng = np.random.default_rng(7)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint32) for _ in range(2))
        if rng.random() < 0.5 and len(a):
            b = np.concatenate([a[: len(a) // 2], b, a[len(a) // 2 :]])
        assert syncmers.likeness(a, b) == brute_likeness(a, b)
        assert syncmers.likeness(a, a) == 1.0


def brute(rows):
    def order(r):
        return (r[0] is not None, r[0] or 0, sha256((r[1] or "").encode()).hexdigest())

    ordered = sorted(rows, key=order)
    texts = [r[1] or "" for r in ordered]
    out = Counter()
    for i, (r, text) in enumerate(zip(ordered, texts)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, next_ = syncmers.fingerprints([text, changed, following])
        out[
            r[0], len(text), sha256(changed.encode()).hexdigest(), syncmers._text(own), syncmers._text(other),
            brute_likeness(own, other), brute_likeness(own, next_),
        ] += 1
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, 2, "clash", 3) for r in rows], SCHEMA)


def got(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def rows_of(seed, n=60):
    rng = np.random.default_rng(seed)
    return [(int(i) * 7 - 100, text_of(rng, int(rng.integers(0, 400)))) for i in rng.permutation(n)]


AWKWARD = [
    (None, None), (None, "lost"), (None, "lost"), (1, ""), (1, "some text that is long enough to have a few anchors in it"), (2, None), (-5, "é漢𝄞" * 30),
    (3, "x" * 5000), (4, "word " * 40_000), (4, "word " * 40_000), (9, "a"),
]


@pytest.mark.parametrize("rows", [AWKWARD, rows_of(1), [(1, "only one document, which is its own next")], [(5, "b" * 99), (4, "a")]])
def test_fingerprints(spark, rows):
    assert got(syncmers.syncmer_fingerprints(table(spark, rows).repartition(3))) == brute(rows)


def test_more_partitions_than_rows(spark, settings):
    settings(spark__sql__shuffle__partitions="31")
    assert got(syncmers.syncmer_fingerprints(table(spark, rows_of(2, 20)).repartition(4))) == brute(rows_of(2, 20))


def test_copies_without_an_id_are_cut(spark, settings):
    settings(spark__sql__shuffle__partitions="16")
    copies = spark.range(4000, numPartitions=5).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text " * 9).alias("text"))
    made = syncmers.syncmer_fingerprints(copies)
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 700
    assert made.filter("near_next = 1.0").count() == 4000


def test_half_of_an_edited_text_matches(spark):
    rng = np.random.default_rng(3)
    rows = [(i, text_of(rng, 3000)) for i in range(20)]
    made = syncmers.syncmer_fingerprints(table(spark, rows)).agg(F.min("near_edited"), F.max("near_edited"), F.max("near_next")).first()
    assert 0.4 < made[0] <= made[1] < 0.6 and made[2] < 0.05


def test_no_rows(spark):
    made = syncmers.syncmer_fingerprints(spark.createDataFrame([], SCHEMA))
    assert made.columns == COLUMNS and made.count() == 0


def test_anchor_rows(spark):
    rows = rows_of(4, 10)
    want = Counter((i, at, h - (h >> 63 << 64)) for i, t in rows for at, h in zip(*(x.tolist() for x in syncmers.closed_syncmers([t])[0])))
    assert Counter(tuple(r) for r in syncmers.anchors(table(spark, rows)).collect()) == want
