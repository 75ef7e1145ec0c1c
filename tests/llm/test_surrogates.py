"""Replacement of personal data against plain Python with the same table of surrogates."""

from collections import Counter
from hashlib import sha256

import numpy as np

from crispstar.llm import surrogates
from tests.llm.test_operators import table

KEY = b"k"
HELD = [
    "mail a.b{n}@host.example.com now", "call +1 (234) 567-{n:04}", "at 10.20.{n}.4", "card 4111 1111 1111 1111", "ssn 123-45-{n:04}",
    "key " + "b44e15e09fd311c3cf3163b66d5a98" + "{n:04}", "IBAN DE89 3704 0044 0532 0130 00 and", "see 2001:db8::ff00:42:{n}", "Mr. John Smith{n} met Dr. Anna Weber",
    "г-н Иван Петров", "Señor García said García", "Smith alone", "nothing here", "plain 12 15", "Rev", "don don.", "a::b", "12:30:45", "AB12", "@", "1.2.3",
]


def made(seed, n):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(HELD[j].format(n=int(rng.integers(0, 9))) for j in rng.integers(0, len(HELD), rng.integers(0, 6))), "s") for i in range(n)]
    return [*rows, (None, None, "s"), (3, "", "s"), (3, HELD[8].format(n=1), "s"), (3, HELD[8].format(n=1), "s"), (n, "Mrs Eva Roth " + "word " * 30_000, "s")]


def test_against_plain_python(spark):
    rows = made(1, 120)
    seen = {(k, v) for _, t, _ in rows for *_, pieces in surrogates.found_in(t or "") for _, _, k, v in pieces if k != "initial"}
    told = {v: k for k, v in sorted(seen, reverse=True) if k in ("given-m", "given-f")}
    as_kind = {(k, v): told.get(v, k) if k == "given-u" else k for k, v in seen}
    values = spark.createDataFrame(sorted({(k, v) for (_, v), k in as_kind.items()}), "kind string, value string")
    given = {(r.kind, r.value): r.surrogate for r in surrogates.assigned(values, KEY).collect()}
    assert len(set(given.values())) == len(given) and not set(given.values()) & {v for _, v in seen}
    want = Counter()
    for i, text, _ in rows:
        found = surrogates.found_in(text or "")
        new = text
        for *_, pieces in reversed(found):
            for a, b, kind, value in reversed(pieces):
                to = surrogates.initial(value, KEY) if kind == "initial" else given[as_kind[kind, value], value]
                new = new[:a] + surrogates.dressed(text[a:b], kind, to) + new[b:]
        want[i, new, len(found), sha256((new or "").encode()).hexdigest()] += 1
    got = surrogates.replace_personal(table(spark, rows), KEY).select("doc_id", "text", "n_entities", "text_sha256").collect()
    assert Counter(map(tuple, got)) == want and sum(r.n_entities for r in got) > 150


def test_no_pattern_matches_where_it_is_said_to_be_impossible():
    texts = [t or "" for _, t, _ in made(2, 400)]
    every = surrogates._any_of(tuple(surrogates.PATTERNS))
    for text in texts:
        kinds = surrogates.possible(text.encode(), text)
        assert {m.lastgroup for m in every.finditer(text)} <= set(kinds)
        if kinds:
            assert [m.span() for m in every.finditer(text)] == [m.span() for m in surrogates._any_of(kinds).finditer(text)]


def test_account_numbers_keep_valid_check_digits():
    for value in ("DE89370400440532013000", "GB82WEST12345698765432"):
        new = surrogates.surrogate("iban", value.lower().upper(), 0, KEY)
        assert surrogates._iban_rest(value) == surrogates._iban_rest(new) == 1 and new != value and len(new) == len(value)
