"""Typing and null rules of the column functions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlane.functions import columns as col
from marketlane.functions import mismatch


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def lit(text):
    return F.lit(text).cast("string")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("  a b ", "a b"),
        ("\t\n x　 ", "x"),
        ("", None),
        (" \t\r\n ", None),
        (None, None),
        ("a\tb", "a\tb"),
    ],
)
def test_clean_text_trims_all_white_space(spark, text, expected):
    assert value(spark, col.clean_text(lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected", [("40", 40), ("40.0", None), ("abc", None), ("", None), ("01037", 1037)]
)
def test_to_long(spark, text, expected):
    assert value(spark, col.to_long(lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected", [("40.0", 40), ("2.5", 3), ("-2.5", -3), ("x", None), (None, None)]
)
def test_measure_to_long_rounds_half_away(spark, text, expected):
    assert value(spark, col.measure_to_long(lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2017-05-01 10:20:30", datetime(2017, 5, 1, 10, 20, 30)),
        (" 2017-05-01\n", datetime(2017, 5, 1)),
        ("2017", None),
        ("2017-05", None),
        ("2017-13-01", None),
        ("yesterday", None),
        ("", None),
    ],
)
def test_to_timestamp_needs_a_full_date(spark, text, expected):
    stamp = col.to_timestamp(lit(text)).cast("timestamp_ntz")
    assert value(spark, stamp) == expected


def test_to_numeric_keeps_nine_decimals(spark):
    assert value(spark, col.to_numeric(lit("1.1234567895"))) == Decimal("1.123456790")
    assert value(spark, col.to_numeric(lit("n/a"))) is None


def test_extremes_are_null_when_an_argument_is(spark):
    one, none = F.lit(1), F.lit(None).cast("int")
    assert value(spark, col.greatest_or_null(one, none)) is None
    assert value(spark, col.least_or_null(one, none)) is None
    assert value(spark, col.greatest_or_null(one, F.lit(3))) == 3
    assert value(spark, col.least_or_null(one, F.lit(3))) == 1


def test_ratios(spark):
    assert value(spark, col.ratio(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, col.ratio(F.lit(1), F.lit(0))) is None
    money = F.lit("10").cast(col.NUMERIC)
    assert value(spark, col.money_ratio(money, F.lit(4))) == Decimal("2.500000000")
    assert value(spark, col.money_ratio(money, F.lit(0))) is None


def test_sum_of_sums_keeps_scale(spark):
    frame = spark.createDataFrame([("0.123456789",), ("0.000000001",)], "x string").select(
        F.col("x").cast(col.NUMERIC).alias("x")
    )
    both = frame.agg((col.money_sum("x") + col.money_sum("x")).alias("s")).first()["s"]
    assert both == Decimal("0.246913580")


@pytest.mark.parametrize(
    "delivered, cancelled, late, days, expected",
    [
        (True, False, False, None, "on_time"),
        (True, False, True, 1, "1_to_3_days"),
        (True, False, True, 3, "1_to_3_days"),
        (True, False, True, 4, "4_to_7_days"),
        (True, False, True, 7, "4_to_7_days"),
        (True, False, True, 8, "8_to_14_days"),
        (True, False, True, 14, "8_to_14_days"),
        (True, False, True, 15, "15_plus_days"),
        (True, True, False, None, "not_delivered"),
        (False, False, False, None, "not_delivered"),
        (None, None, None, None, "not_delivered"),
        (True, None, None, None, "on_time"),
        (True, False, True, None, "not_delivered"),
    ],
)
def test_delay_bucket(spark, delivered, cancelled, late, days, expected):
    bucket = col.delay_bucket(
        F.lit(delivered).cast("boolean"),
        F.lit(cancelled).cast("boolean"),
        F.lit(late).cast("boolean"),
        F.lit(days).cast("bigint"),
    )
    assert value(spark, bucket) == expected


def test_week_starts_on_monday(spark):
    assert value(spark, col.week_start(F.lit(date(2024, 1, 7)))) == date(2024, 1, 1)
    assert value(spark, col.week_start(F.lit(date(2024, 1, 8)))) == date(2024, 1, 8)


@pytest.mark.parametrize("left, right", [(1, 1), (1, 2), (1, None), (None, 1), (None, None)])
def test_mismatches(spark, left, right):
    a, b = F.lit(left).cast("int"), F.lit(right).cast("int")
    one_null = (left is None) != (right is None)
    both_null = left is None and right is None
    assert value(spark, mismatch.exact(a, b)) is (one_null or both_null or left != right)
    assert value(spark, mismatch.within(a, b, 1.5)) is (one_null or both_null)
    assert value(spark, mismatch.nullable_exact(a, b)) is (left != right)
    assert value(spark, mismatch.nullable_within(a, b, 0.5)) is (left != right)
    by_sql = value(spark, mismatch.nullable_exact(a, b, sql_null_logic=True))
    assert by_sql is (None if one_null else left != right)
    by_sql = value(spark, mismatch.nullable_within(a, b, 0.5, sql_null_logic=True))
    assert by_sql is (None if one_null else left != right)
