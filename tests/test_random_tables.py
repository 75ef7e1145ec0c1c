"""Operators against plain Python on random small tables."""

from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from crispstar.operators import uniqueness, values
from crispstar.operators.incremental import incremental_load
from crispstar.operators.keys import surrogate_key
from crispstar.plans import gold
from tests.conftest import rows

KEYS = st.sampled_from(["a", "b", "c", "", None])
AMOUNTS = st.sampled_from(["1", "-1", "2.5", "-2.5", "0", "1,000", "x", "", None])
TABLE = st.lists(st.tuples(KEYS, AMOUNTS, st.integers(0, 2)), max_size=25)
SCHEMA = "k string, amount string, n int"
FEW = settings(max_examples=8, deadline=None)


def first(row):
    return [(x is not None, x if x is not None else 0) for x in row]


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


@FEW
@given(TABLE)
def test_keys(spark, table):
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    groups = defaultdict(list)
    for row in table:
        groups[row[0]].append(row)
    counts = {k: len(g) for k, g in groups.items()}
    assert dict(rows(uniqueness.duplicate_keys(df, "k"))) == {k: n for k, n in counts.items() if n > 1}
    kept = {k: min(g, key=first) for k, g in groups.items()}
    assert Counter(map(tuple, uniqueness.dedup_by_key(df, "k").collect())) == Counter(kept.values())
    duplicated = [r for r in table if r[0] is not None and counts[r[0]] > 1]
    assert Counter(map(tuple, uniqueness.duplicate_records(df, "k").collect())) == Counter(duplicated)
    unique = [r for r in table if r[0] is None or counts[r[0]] == 1]
    assert Counter(map(tuple, uniqueness.unique_records(df, "k").collect())) == Counter(unique)


@FEW
@given(TABLE)
def test_signs(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    found = defaultdict(list)
    for k, amount, _ in table:
        found[k].append(number(amount))
    flags = {
        k: (int(any(v is not None and v < 0 for v in vs)), int(any(v is not None and v > 0 for v in vs)))
        for k, vs in found.items()
    }
    assert {r[0]: tuple(r[1:]) for r in values.sign_flags(df, "amount", "k").collect()} == flags
    below = {k: sum(v is not None and v < 0 for v in vs) for k, vs in found.items()}
    signed = {r[0]: tuple(r[1:]) for r in values.signed_counts(df, "amount", "k").collect()}
    assert signed == {k: (n, len(found[k]) - n) for k, n in below.items()}
    pairs = {
        (k, abs(v)) for k, vs in found.items() for v in vs if v is not None and v > 0 and -v in vs
    }
    assert {(r[0], r[1]) for r in values.offset_pairs(df, "k", "amount").collect()} == pairs


@FEW
@given(TABLE, TABLE)
def test_keys_numbers_and_lookups(spark, facts, dims):
    fact = spark.createDataFrame(facts, SCHEMA)
    dim = surrogate_key(spark.createDataFrame(dims, SCHEMA).coalesce(1), ["k"], "key")
    numbered = sorted(map(tuple, dim.collect()))
    assert [r[0] for r in numbered] == list(range(1, len(dims) + 1))
    assert [r[1:] for r in numbered] == sorted(dims, key=first)
    joined = gold.with_key(fact, dim, fact["k"], "key", "found", "k").collect()
    expected = []
    for row in facts:
        hits = [n for n, k, *_ in numbered if k is not None and k == row[0]] or [None]
        expected += [(*row, n) for n in hits]
    assert Counter(map(tuple, joined)) == Counter(expected)


@FEW
@given(TABLE, TABLE)
def test_upsert(spark, current, batch):
    got = incremental_load(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(batch, SCHEMA), "k")
    winners = {}
    for row in sorted(batch, key=first):
        winners.setdefault(row[0], row)
    kept = [r for r in current if r[0] not in winners]
    assert Counter(map(tuple, got.collect())) == Counter([*kept, *winners.values()])
