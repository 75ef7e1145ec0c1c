"""Column functions on literal rows."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crispstar import functions as fn
from crispstar.functions import synonyms, temporal
from crispstar.functions.temporal import shift_hours
from crispstar.functions.text import drop_phone_prefix, phone_digits


def apply(spark, function, values, type_name="string"):
    """The function over a list of values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_name}")
    return [r[0] for r in df.orderBy("i").select(function("c")).collect()]


CASES = [
    (fn.clean_person_name, [" al1ce ", "BOB", "o'neil mary-jane", "de la  cruz2", "42", None],
     ["Alce", "Bob", "O'neil Mary-jane", "De La  Cruz", "", None]),
    (fn.clean_agent, ["agent_07 smith", "JANE  doe9", "42", "", None], ["Agent Smith", "Jane  Doe", "", "", None]),
    (fn.clean_phone,
     ["001-555-0000001x12", "+1-555-0000002", " 555.0000003", "0000004", "555X12", "12x3x4", "0015550000001x",
      "15550000002", "01550000002", None],
     ["5550000001", "5550000002", "5550000003", "0000004", "55512", "12", "5550000001", "5550000002",
      "01550000002", None]),
    (fn.clean_quantity,
     ["five", " FIVE ", "2.0", " 2.0 ", "", "-3", " -3 ", "3.0", "-4", " 7 ", "+8", "\t9\n", "n/a", "1e3",
      "99999999999", None],
     [5, 5, 2, 2, None, None, None, None, -4, 7, 8, 9, None, None, None, None]),
    (fn.clean_amount,
     ["1,234.5", "-50", "2.345", "1234.567", "N/A", "", "123456789.00", "1e3", None],
     [Decimal("1234.50"), Decimal("-50.00"), Decimal("2.35"), Decimal("1234.57"), None, None, None,
      Decimal("1000.00"), None]),
    (fn.as_number, ["1,234.5", "-1", "free", "", "1e3", None], [1234.5, -1.0, None, None, 1000.0, None]),
    (fn.parse_date_multi,
     ["2024-01-02T08:30:00.000000", "2024-01-02", "02-01-2024", "2024-02-30", "31-12-2023", " 2024-01-02",
      "2024-01-02 10:00:00", "bad", "2024-13-01", "2024-01-02T25:00:00.000000", None],
     [dt.date(2024, 1, 2), dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, dt.date(2023, 12, 31), None, None,
      None, None, None, None]),
    (fn.parse_ts_multi,
     ["2024-01-02 10:00:00", "01/02/2024 10:30", "02-01-2024 11:45", "2024-01-02T10:00:00", "13/13/2024 10:30", None],
     [dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 10, 30), dt.datetime(2024, 1, 2, 11, 45), None, None, None]),
    (fn.parse_ts_iso,
     ["2024-01-02T10:00:00", "2024-01-02 10:00:00", "2024-01-02 10:00:00.250", " 2024-01-02 10:00:00", "2024-01-02",
      "2024-01-02 24:00:00", None],
     [dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 10), None, None, None, None, None]),
    (fn.parse_ts_lenient,
     ["2024-01-02T10:00:00", "2024-01-02 10:00:00.250", "2024-01-02", "x", "", None],
     [dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 10, 0, 0, 250000), dt.datetime(2024, 1, 2), None, None, None]),
    (fn.standardize_status, [" SUC", "success", "Fail ", "REF", " refunded", "zzz", "", None],
     ["success", "success", "failed", "refunded", "refunded", None, None, None]),
    (lambda c: fn.standardize_status(c, draft=True), [" SUC", "REF", "Zzz ", None], ["suc", "refunded", "zzz", None]),
    (fn.standardize_payment, ["CRAD", "c@rd", "cd ", "Wall-et", "UPI", "cash", "iou", None],
     ["card", "card", "card", "wallet", "upi", "cash", None, None]),
    (lambda c: fn.standardize_payment(c, draft=True), ["CRAD", "c@rd", None], ["card", "c@rd", None]),
    (fn.standardize_category, ["CLO", " aut", "kitchen_", "toys_", "sports_", "Home", "odd ", None],
     ["clothing", "automotive", "kitchen_", "toys_", "sports_", "home", "odd ", None]),
    (lambda c: fn.standardize_category(c, "draft"), ["kitchen_", "toys_", "sports_", "odd "],
     ["kitchen", "toys", "sports", "odd "]),
    (lambda c: fn.standardize_category(c, "audit"), ["kitchen_", "toy", "odd"], [None, "toys", None]),
    (fn.standardize_issue, ["tcudorp", "PAY", "d3lay", " Refundx", "other", None],
     ["Product", "Payment", "Delay", "Refund", None, None]),
    (fn.standardize_sentiment, ["pos", "N3gativ3", " neutral", "?", None],
     ["Positive", "Negative", "Neutral", None, None]),
    (fn.title_case, [" CLICK", "page view", None], ["Click", "Page View", None]),
    (fn.is_blank, ["", "  ", "a", "\t", None], [True, True, False, False, True]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_literal_rows(spark, case):
    function, given_values, expected = CASES[case]
    assert apply(spark, function, given_values) == expected


def test_every_spelling_maps_to_its_value(spark):
    for function, table in [
        (fn.standardize_status, synonyms.STATUS),
        (fn.standardize_payment, synonyms.PAYMENT),
        (fn.standardize_category, synonyms.CATEGORY),
        (fn.standardize_issue, synonyms.ISSUE),
        (fn.standardize_sentiment, synonyms.SENTIMENT),
    ]:
        pairs = [(f" {s.upper()} ", value) for value, spellings in table.items() for s in spellings]
        assert apply(spark, function, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_guards_do_not_change_a_cast(spark):
    odd = ["1", " 1 ", "+1", "-0", "1.", ".5", "1d", "1f", "NaN", "nan", "Infinity", "-inf", "+INF", "0x1p3", "1e400",
           "1_000", "\u0663", "\u0663.\u0665", "1\u00a0", "\u20031", "1\u2028", "1\u0085", "\x1c2", "\x7f3", "--1", "+",
           "", " ", "true", "2147483648", "1 2", "\uff11"]
    df = spark.createDataFrame([(x,) for x in odd], "c string")
    for kind in ("int", "bigint", "double", "decimal(10,2)"):
        plain, guarded = F.col("c").try_cast(kind), fn.parse_number("c", kind)
        assert df.filter(~plain.cast("string").eqNullSafe(guarded.cast("string"))).collect() == []
    commas = [*odd, "1,234.5", ",", ",,1", "n,an", "N/A", "-i,nf", "1,2,3"]
    df = spark.createDataFrame([(x,) for x in commas], "c string")
    for kind in ("double", "decimal(10,2)"):
        plain, guarded = F.translate("c", ",", "").try_cast(kind), fn.as_number("c", kind)
        assert df.filter(~plain.cast("string").eqNullSafe(guarded.cast("string"))).collect() == []
    stamps = ["2024-01-02", "2024", "T10:00", "now", "epoch", "12:30", "x", "2024-01-02T10:00:00Z"]
    df = spark.createDataFrame([(x,) for x in stamps], "c string")
    plain = F.col("c").try_cast("timestamp").cast("timestamp_ntz")
    assert df.filter(~plain.eqNullSafe(fn.parse_ts_lenient("c"))).count() == 0


def test_shapes_and_casts_do_not_change_a_parse(spark):
    days = ["2024-01-02", "2024-1-2", "02-01-2024", "02024-01-02", "2024-01-02 ", "0000-01-01", "9999-12-31",
            "2023-02-29", "2024-02-29", "01-01-0000", "31-04-2024", "2024-00-10", "1582-10-10", "0001-01-01",
            "2024-01-2 ", "+024-01-02", "-024-01-02", "2024-01-02\n"]
    times = ["08:30:00", "24:00:00", "23:59:59", "23:59:60", "08:60:00", "08:30", "8:30:00", "08:30:00.1",
             "08:30:00.123456", "08:30:00.1234567", "08:30:00.", "08:30:00Z", "08:30:00+01:00"]
    texts = [*days, *(f"2024-01-02{sep}{t}" for sep in "T " for t in times), "01/02/2024 08:30", "01-02-2024 08:30"]
    df = spark.createDataFrame([(x,) for x in texts], "c string")
    plain = F.coalesce(*[F.try_to_date("c", f) for f in temporal.DATE_FORMATS])
    assert df.filter(~plain.eqNullSafe(fn.parse_date_multi("c"))).collect() == []
    plain = F.coalesce(*[F.try_to_timestamp("c", F.lit(f)) for f in temporal.TIMESTAMP_FORMATS]).cast("timestamp_ntz")
    assert df.filter(~plain.eqNullSafe(fn.parse_ts_multi("c"))).collect() == []
    plain = F.try_to_timestamp(F.translate("c", "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    assert df.filter(~plain.eqNullSafe(fn.parse_ts_iso("c"))).collect() == []


def test_hours(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 10:00:00' AS a, timestamp_ntz'2024-01-01 11:30:18' AS b, 5.9D AS h, -4.5D AS n"
    )
    got = df.select(
        fn.hours_between("a", "b"), fn.hours_between("b", "a"), shift_hours("a", "h"), shift_hours("a", "h", -1),
        shift_hours("a", "n"),
    ).first()
    assert tuple(got) == (
        1.51, -1.51, dt.datetime(2024, 1, 1, 15), dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6)
    )


def test_fallbacks(spark):
    table = {"x": ("a",)}
    assert apply(spark, lambda c: fn.map_synonyms(c, table, "raw"), [" A", " Q "]) == ["x", " Q "]
    assert apply(spark, lambda c: fn.map_synonyms(c, table, "normalized"), [" A", " Q "]) == ["x", "q"]
    with pytest.raises(ValueError):
        fn.map_synonyms("c", table, "other")


def test_synonym_join_equals_map(spark):
    pairs = [(s, v) for v, spellings in synonyms.ISSUE.items() for s in spellings]
    mapping = spark.createDataFrame(pairs, "s string, v string")
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["PAY", " delay", "odd", None])], "i int, issue string")
    for otherwise in synonyms.FALLBACKS:
        joined = fn.synonym_join(df, "issue", mapping, "s", "v", otherwise)
        mapped = df.withColumn("issue", fn.map_synonyms("issue", synonyms.ISSUE, otherwise))
        assert sorted(map(str, joined.collect())) == sorted(map(str, mapped.collect()))


TEXT = st.text(alphabet=st.sampled_from("aZé09 x.-_+'\n"), max_size=18)


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_against_plain_python(spark, texts):
    def digits(s):
        return re.sub("[^0-9]", "", re.sub("x.*$", "", s))

    def short(s):
        d = digits(s)
        if len(d) == 13 and d.startswith("001"):
            return d[3:]
        return d[1:] if len(d) == 11 and d.startswith("1") else d

    def title(s):
        return " ".join(w[:1].upper() + w[1:].lower() for w in s.strip(" ").split(" "))

    assert apply(spark, phone_digits, texts) == [digits(s) for s in texts]
    assert apply(spark, fn.clean_phone, texts) == [short(s) for s in texts]
    assert apply(spark, fn.clean_person_name, texts) == [title(re.sub("[0-9]", "", s)) for s in texts]
    assert apply(spark, fn.clean_agent, texts) == [title(re.sub("[^A-Za-z ]", "", s)) for s in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_cleaning_twice_changes_nothing(spark, texts):
    for clean in (fn.clean_person_name, fn.clean_agent, phone_digits):
        once = apply(spark, clean, texts)
        assert apply(spark, clean, once) == once


def test_prefix_is_dropped_once(spark):
    assert apply(spark, drop_phone_prefix, ["11234567890", "0011234567890", "111234567890"]) == [
        "1234567890", "1234567890", "111234567890"
    ]
