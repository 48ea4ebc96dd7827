"""Semantics that differ between the warehouse dialect and Spark's own functions."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as fn


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = [tuple(v for _, v in values.values())] if values else [(1,)]
    return spark.createDataFrame(row, schema).select(column).first()[0]


def test_strip_removes_tabs_and_newlines(spark):
    assert one(spark, fn.strip(F.lit("\t a b \n"))) == "a b"


def test_greatest_and_least_are_null_with_a_null(spark):
    assert one(spark, fn.strict_greatest(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, fn.strict_least(F.lit(1), F.lit(3))) == 1


@pytest.mark.parametrize("x, want", [(2.7, 3), (2.5, 3), (-2.5, -3), (-0.4, 0)])
def test_cast_to_integer_rounds(spark, x, want):
    assert one(spark, fn.round_to_long(F.lit(x))) == want


@pytest.mark.parametrize("x, digits, want", [(-2.79, 0, -2.0), (2.79, 1, 2.7), (-2.79, 1, -2.7)])
def test_trunc_cuts_toward_zero(spark, x, digits, want):
    assert one(spark, fn.truncate_to(F.lit(x), digits)) == pytest.approx(want)


def test_regexp_first_is_null_without_match(spark):
    assert one(spark, fn.regexp_first(F.lit("abc"), "([0-9]+)")) is None
    assert one(spark, fn.regexp_first(F.lit("a12"), "([0-9]+)")) == "12"


def test_split_takes_the_delimiter_literally(spark):
    assert one(spark, fn.split_text(F.lit("a|b|"), "|")) == ["a", "b", ""]
    assert one(spark, fn.split_at(F.lit("a||c"), "|", 1)) is None


def test_sentinel_and_numeric_parsing(spark):
    assert one(spark, fn.null_if_sentinel(F.lit("-999"))) is None
    assert one(spark, fn.null_if_sentinel(F.lit("x"))) is None
    assert float(one(spark, fn.parse_numeric(F.lit(" 12.5\t")))) == 12.5


@pytest.mark.parametrize(
    "end, start, part, want",
    [
        ("2024-02-01", "2024-01-31", "MONTH", 1),
        ("2024-03-30", "2024-02-01", "MONTH", 1),
        ("2024-01-01", "2023-12-31", "YEAR", 1),
        ("2024-01-07", "2024-01-06", "WEEK", 1),  # Saturday to Sunday
        ("2024-01-07", "2024-01-06", "ISOWEEK", 0),
        ("2024-01-08", "2024-01-07", "ISOWEEK", 1),
        ("2024-04-01", "2024-03-31", "QUARTER", 1),
        ("2024-03-01", "2024-02-01", "DAY", 29),
    ],
)
def test_date_diff_counts_boundaries(spark, end, start, part, want):
    day = lambda d: F.lit(d).cast("date")
    assert one(spark, fn.date_diff(day(end), day(start), part)) == want


def test_datetime_diff_counts_boundaries_and_timestamp_diff_whole_units(spark):
    a, b = F.lit("2024-01-01 10:59:59").cast("timestamp_ntz"), F.lit("2024-01-01 11:00:01").cast("timestamp_ntz")
    assert one(spark, fn.datetime_diff(b, a, "HOUR")) == 1
    assert one(spark, fn.timestamp_diff(b, a, "HOUR")) == 0


def test_date_text(spark):
    ok = lambda s: one(spark, fn.try_parse_date(F.lit(s), "%Y-%m-%d"))
    assert ok("2024-02-29") == date(2024, 2, 29)
    for bad in ("2024-13-01", "2024-01-32", "2024/01/01", ""):
        assert ok(bad) is None


def test_patterns():
    assert fn.java_pattern("%Y%m%d") == "yyyyMMdd"
    assert fn.java_pattern("%Y-%m-%dT%H:%M:%S") == "yyyy-MM-dd'T'HH:mm:ss"
    with pytest.raises(ValueError):
        fn.java_pattern("%Q")


def test_julian_and_clock_integers(spark):
    assert one(spark, fn.from_julian(F.lit(2024060))) == date(2024, 2, 29)
    assert one(spark, fn.from_julian(F.lit(0))) is None
    assert one(spark, fn.to_julian(F.lit("2024-12-31").cast("date"))) == 2024366
    assert one(spark, fn.hhmmss(F.lit(70509))) == "07:05:09"
    assert one(spark, fn.hhmmss(F.lit(0))) is None


def test_local_time_follows_summer_time(spark):
    local = lambda s: one(spark, fn.zoned_local(F.lit(s).cast("timestamp_ntz")))
    assert local("2024-01-15 12:00:00") == datetime(2024, 1, 15, 7)
    assert local("2024-07-15 12:00:00") == datetime(2024, 7, 15, 8)


@pytest.mark.parametrize("day, want", [("2024-01-06", 8), ("2024-01-07", 8), ("2024-01-08", 8), ("2024-01-05", 5)])
def test_business_day(spark, day, want):
    assert one(spark, fn.business_day(F.lit(day).cast("date"))) == date(2024, 1, want)


@pytest.mark.parametrize("text, want", [("046454286", True), ("046454287", False), ("4539578763621486", True), ("12a", False)])
def test_luhn(spark, text, want):
    assert one(spark, fn.luhn_valid(F.lit(text))) is want


def test_check_digit_makes_a_valid_number(spark):
    assert one(spark, fn.with_check_digit(F.lit("7992739871"))) == "79927398713"
    assert one(spark, fn.luhn_valid(F.lit(None).cast("string"))) is None


def test_key_hash_is_null_with_a_null_key_and_ambiguous_without_separator(spark):
    df = spark.createDataFrame([("1", "23", None), ("12", "3", "x")], "a string, b string, c string")
    joined = [r[0] for r in df.select(fn.key_hash(["a", "b"])).collect()]
    assert joined[0] == joined[1]
    apart = [r[0] for r in df.select(fn.key_hash(["a", "b"], "|")).collect()]
    assert apart[0] != apart[1]
    assert df.select(fn.key_hash(["a", "c"])).first()[0] is None


@pytest.mark.parametrize("limit, want", [(3, "éa"), (2, "é"), (1, ""), (4, "éaé"[:2]), (5, "éaé")])
def test_bytes_are_cut_between_characters(spark, limit, want):
    assert one(spark, fn.fits_bytes(F.lit("éaé"), limit)) == want


def test_json_scalar_ignores_objects_and_arrays(spark):
    doc = F.lit('{"a":1,"b":{"c":2},"d":[1,2]}')
    assert one(spark, fn.json_scalar(doc, "$.a")) == "1"
    assert one(spark, fn.json_scalar(doc, "$.b")) is None
    assert one(spark, fn.json_scalar(doc, "$.d")) is None
    assert one(spark, fn.json_array(doc, "$.d", "int")) == [1, 2]


def test_range_bucket(spark):
    bucket = lambda x: one(spark, fn.range_bucket(F.lit(x), [0, 10, 20]))
    assert [bucket(x) for x in (-1, 0, 10, 15, 20)] == [0, 1, 2, 2, 3]


def test_cents_are_exact(spark):
    assert one(spark, fn.cents(F.lit(1.15))) == 115
    assert one(spark, fn.cents(F.lit(-0.29))) == -29
