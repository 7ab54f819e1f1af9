import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftlode.functions import scalars as S


def values(spark, column, rows, schema="x double, y double"):
    df = spark.createDataFrame(rows, schema)
    return [row[0] for row in df.select(column).collect()]




def test_nan_becomes_null(spark):
    assert values(spark, S.as_double(F.col("x")), [(float("nan"), 0.0), (1.0, 0.0)]) == [None, 1.0]


def test_clamps_keep_missing_values(spark):
    rows = [(-1.0, 0.0), (0.0, 0.0), (10.0, 0.0), (10.5, 0.0), (None, 0.0)]
    assert values(spark, S.clamp_negative(F.col("x")), rows) == [0.0, 0.0, 10.0, 10.5, None]
    assert values(spark, S.clamp_range(F.col("x"), 0.0, 10.0), rows) == [0.0, 0.0, 10.0, 10.0, None]


def test_clamp_is_idempotent(spark):
    rows = [(-3.0, 0.0), (4.0, 0.0), (12.0, 0.0)]
    once = S.clamp_range(F.col("x"), 0.0, 10.0)
    assert values(spark, once, rows) == values(spark, S.clamp_range(once, 0.0, 10.0), rows)


def test_fuel_efficiency(spark):
    rows = [(5.0, 10.0), (5.0, 0.0), (None, 10.0), (None, 0.0), (5.0, None)]
    result = values(spark, S.fuel_efficiency(F.col("x"), F.col("y")), rows)
    assert result == [0.5, 0.0, None, 0.0, 0.0]


@pytest.mark.parametrize(
    "temperature, rain, score",
    [
        (25.0, 5.0, 100.0),
        (25.0, 6.0, 98.0),
        (27.0, 0.0, 97.0),
        (23.0, 0.0, 97.0),
        (25.0, 100.0, 0.0),
        (26.0, None, 98.5),
        (None, 3.0, None),
    ],
)
def test_weather_impact(spark, temperature, rain, score):
    assert values(spark, S.weather_impact_score(F.col("x"), F.col("y")), [(temperature, rain)]) == [score]


def test_high_precipitation_counts_missing_as_dry(spark):
    assert values(spark, S.high_precipitation(F.col("x")), [(5.0, 0.0), (5.1, 0.0), (None, 0.0)]) == [0, 1, 0]


def test_health_buckets(spark):
    rows = [(score, 0.0) for score in (95.0, 94.9, 85.0, 84.9, 70.0, 69.9)]
    expected = ["excellent", "good", "good", "fair", "fair", "poor"]
    assert values(spark, S.health_bucket(F.col("x")), rows) == expected


def test_severity_needs_more_than_three_stds(spark):
    result = values(spark, S.severity(F.col("x"), F.lit(0.0), F.lit(1.0)), [(3.0, 0.0), (3.1, 0.0), (-3.1, 0.0)])
    assert result == ["medium", "high", "high"]


def test_flags_drop_zero_counts(spark):
    flags = S.present(S.count_flag("a", F.col("x").cast("int")), S.count_flag("b", F.col("y").cast("int")))
    assert values(spark, flags, [(2.0, 0.0), (0.0, 0.0)]) == [["a_2"], []]


def test_source_kind_and_days(spark):
    df = spark.sql("SELECT DATE '2024-07-01' AS a, DATE '2024-07-03' AS b")
    row = df.select(
        S.source_kind(F.col("a"), F.col("a")), S.source_kind(F.col("b"), F.col("a")), S.days_inclusive(F.col("a"), F.col("b"))
    ).first()
    assert tuple(row) == ("historical", "forecast", 3)


def test_calendar_parts_are_iso(spark):
    df = spark.sql("SELECT DATE '2024-12-30' AS d")  # a Monday in ISO week 1
    row = df.select(*[column.alias(name) for name, column in S.date_parts(F.col("d")).items()]).first()
    assert row.asDict() == {
        "year": 2024, "month": 12, "day": 30, "day_of_year": 365, "week_of_year": 1, "day_of_week": 0, "is_weekend": 0,
    }


def test_tokens_lose_blanks_and_quotes(spark):
    df = spark.createDataFrame([(" '2024-07-01', 1 ,'Day', -3.5",)], "t string")
    assert df.select(S.tokens(F.col("t"))).first()[0] == ["2024-07-01", "1", "Day", "-3.5"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda number: number + 0.0), min_size=1, max_size=200))
def test_fixed_text_rounds_like_printf(spark, numbers):
    ties = [0.125, 0.375, -0.125, 1.005, 1.015, 2.675, -2.5, 0.5, 1.5, -0.001]
    rows = [(number, 0.0) for number in [*numbers, *ties, *[round(number, 3) + 0.0 for number in numbers]]]
    assert values(spark, S.fixed_text(F.col("x"), 2), rows) == [f"{x:.2f}" for x, _ in rows]
    assert values(spark, S.fixed_text(F.col("x"), 1), rows) == [f"{x:.1f}" for x, _ in rows]


@pytest.mark.parametrize("digits", [1, 2])
def test_fixed_text_of_values_next_to_ties(spark, digits):
    rows = [(number / (2 * 10**digits), 0.0) for number in range(-2001, 2002) if number]
    assert values(spark, S.fixed_text(F.col("x"), digits), rows) == [f"{x:.{digits}f}" for x, _ in rows]


def test_salts_spread_full_copies(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.lit("same").alias("k"))
    assert copies.select(S.salt_of(64, "k").alias("s")).distinct().count() > 4
