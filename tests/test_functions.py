import datetime as dt

import pytest
from pyspark.sql import functions as F

from bvengine.functions import (
    contains_any,
    digits_fixed,
    digits_only,
    null_safe_concat,
    ordered_case,
    repull_cutoff,
    repull_cutoff_col,
    strip_text,
    task_key,
    varchar,
    zip5,
)


def one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


def test_digits_only(spark):
    assert one_col(spark, ["a1b2-3", None, "", "١٢3"], digits_only) == ["123", None, "", "3"]


def test_digits_fixed(spark):
    got = one_col(spark, ["NPI 123-456-7890", "123456789", "12345678901", None], lambda c: digits_fixed(c, 10))
    assert got == ["1234567890", None, None, None]


def test_zip5(spark):
    got = one_col(spark, ["12345-6789", "1234-5678", "123", None, "Z-1", "98765"], zip5)
    assert got == ["12345", "12345", None, None, None, "98765"]


def test_zip5_reads_thirty_characters(spark):
    raw = ["x" * 30 + "12345", "x" * 25 + "12345", "x" * 26 + "12345", "1234" + "-" * 26 + "5", "12345" + "9" * 40, "é" * 25 + "54321", ""]
    assert one_col(spark, raw, zip5) == [None, "12345", None, None, "12345", "54321", None]


def test_varchar(spark):
    assert one_col(spark, ["a" * 31, "b" * 30, "", None], varchar) == ["a" * 30, "b" * 30, "", None]
    assert one_col(spark, ["漢字かな", "🙂🙂🙂"], lambda c: varchar(c, 2)) == ["漢字", "🙂🙂"]
    assert one_col(spark, [12345], lambda c: varchar(c, 3), "int") == ["123"]
    with pytest.raises(ValueError):
        varchar("v", 0)


def test_null_safe_concat_and_task_key(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "x string, y string")
    got = [r[0] for r in df.select(task_key("x", "y")).collect()]
    assert got == ["a b", " b", "a ", " "]
    got = [r[0] for r in df.select(null_safe_concat("x", F.lit("-"), "y")).collect()]
    assert got == ["a-b", "-b", "a-", "-"]


def test_contains_any_three_valued(spark):
    got = one_col(spark, ["my BCBS plan", "Aetna", None], lambda c: contains_any(c, ["BCBS", "Blue"]))
    assert got == [True, False, None]


def test_strip_text_is_literal(spark):
    assert one_col(spark, ["US-CA", "CA", "US-US-", None, "US.CA"], lambda c: strip_text(c, "US-")) == [
        "CA", "CA", "", None, "US.CA"]


def test_ordered_case_first_true_wins_and_null_is_not_true(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    e = ordered_case([(F.col("v") >= 1, "ge1"), (F.col("v") >= 2, "ge2")])
    assert [r[0] for r in df.select(e).collect()] == ["ge1", "ge1", None]
    e2 = ordered_case([(F.col("v") == 2, "two")], otherwise="other")
    assert [r[0] for r in df.select(e2).collect()] == ["other", "two", "other"]


# as_of -> expected cutoff (all seven weekdays of as_of - 100 h)
CUTOFFS = [
    (dt.datetime(2024, 2, 3, 12), dt.datetime(2024, 1, 30, 8)),   # -> Tue, no shift
    (dt.datetime(2024, 2, 1, 12), dt.datetime(2024, 1, 26, 8)),   # -> Sun 28th, -148 h
    (dt.datetime(2024, 1, 31, 12), dt.datetime(2024, 1, 26, 8)),  # -> Sat 27th, -124 h
    (dt.datetime(2024, 2, 2, 12), dt.datetime(2024, 1, 29, 8)),   # -> Mon
    (dt.datetime(2024, 2, 4, 12), dt.datetime(2024, 1, 31, 8)),   # -> Wed
    (dt.datetime(2024, 2, 5, 12), dt.datetime(2024, 2, 1, 8)),    # -> Thu
    (dt.datetime(2024, 2, 6, 12), dt.datetime(2024, 2, 2, 8)),    # -> Fri
]


@pytest.mark.parametrize("as_of,expected", CUTOFFS)
def test_repull_cutoff_scalar(as_of, expected):
    assert repull_cutoff(as_of) == expected


def test_repull_cutoff_column_matches_scalar(spark):
    df = spark.createDataFrame([(a,) for a, _ in CUTOFFS], "ts timestamp_ntz")
    got = [r[0] for r in df.select(repull_cutoff_col("ts")).collect()]
    assert got == [e for _, e in CUTOFFS]
