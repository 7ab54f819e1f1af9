import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode import schemas
from shiftlode.operators import aggregates as A
from shiftlode.plans import daily as D

DAYS = [dt.date(2024, 7, day) for day in range(1, 5)]


@pytest.fixture(scope="module")
def tables(spark):
    logs = spark.createDataFrame(
        [
            (DAYS[0], 1, "Day", -10.0, 4.0),
            (DAYS[0], 1, "Night", 100.0, 12.0),
            (DAYS[1], 1, "Day", 50.0, None),
            (DAYS[2], 1, "Day", None, 3.0),
            (DAYS[3], 1, "Day", 10.0, -1.0),
        ],
        "date date, mine_id int, shift string, tons_extracted double, quality_grade double",
    )

    def reading(day, hour, equipment, status, fuel):
        return (dt.datetime(2024, 7, day, hour), equipment, status, fuel, False)

    sensors = spark.createDataFrame(
        [
            reading(2, 0, "A", "active", 4.0),
            reading(2, 1, "A", "idle", 6.0),
            reading(2, 2, "A", None, None),
            reading(2, 23, "B", "active", 10.0),
            reading(3, 0, "B", "idle", 8.0),
        ],
        schemas.EQUIPMENT_SENSORS,
    )
    weather = spark.createDataFrame(
        [
            (DAYS[0], 2.0, 117.0, 25.0, 10.0, "z"),
            (DAYS[1], 2.0, 117.0, None, 3.0, "z"),
            (DAYS[2], 2.0, 117.0, 27.0, None, "z"),
        ],
        schemas.WEATHER_DATA,
    )
    return logs, sensors, weather


def test_daily_metrics_by_hand(tables):
    rows = [row.asDict() for row in D.transform(*tables).orderBy("date").collect()]
    assert [row["total_production_daily"] for row in rows] == [100.0, 50.0, 0.0, 10.0]
    assert [row["average_quality_grade"] for row in rows] == [7.0, None, 3.0, 0.0]
    # day 2: A is active in one of three readings, B in one of one; then the mean of both
    assert [row["equipment_utilization"] for row in rows] == [50.0, pytest.approx((100 / 3 + 100) / 2), 0.0, 0.0]
    assert [row["avg_fuel_consumption"] for row in rows] == [5.0, 7.5, 8.0, 8.0]
    # efficiency is taken before the fill: unknown on days without sensors, 0 without output
    assert [row["fuel_efficiency"] for row in rows] == [None, 0.15, 0.0, None]
    assert [row["weather_impact_score"] for row in rows] == [90.0, None, 97.0, None]
    assert [row["temperature_mean"] for row in rows] == [25.0, 26.0, 27.0, 26.0]
    assert [row["precipitation_sum"] for row in rows] == [10.0, 3.0, 0.0, 0.0]
    assert all(row["anomaly_flags"] == ["negative_tons_extracted_1", "invalid_quality_grade_2"] for row in rows)


def test_stored_table_has_the_fixed_columns(tables):
    daily = D.daily_metrics(*tables)
    assert daily.columns == V.DAILY_COLUMNS
    assert daily.schema.simpleString() == schemas.DAILY_PRODUCTION_METRICS.simpleString()


def test_empty_inputs_give_an_empty_table(tables):
    logs, sensors, weather = (df.limit(0) for df in tables)
    assert D.daily_metrics(logs, sensors, weather).count() == 0


def test_no_flags_on_clean_records(spark, tables):
    clean = tables[0].where("tons_extracted > 0 AND quality_grade IS NULL")
    rows = D.daily_metrics(clean, *tables[1:]).collect()
    assert [row["anomaly_flags"] for row in rows] == [[]]


def test_failed_checks_are_added_to_every_day(spark):
    daily = spark.createDataFrame(
        [(-1.0, 101.0, None, 1.0, ["x"]), (1.0, 50.0, 1.0, 1.0, []), (None, -1.0, 1.0, None, [])],
        "total_production_daily double, equipment_utilization double, temperature_mean double,"
        " precipitation_sum double, anomaly_flags array<string>",
    )
    errors = ["negative_total_production_1", "invalid_equipment_utilization_2", "missing_weather_data_2"]
    flags = [row["anomaly_flags"] for row in D.validate_metrics(daily).collect()]
    assert flags == [["x", *errors], errors, errors]


def test_raw_records_are_scanned_once_per_table(tables, tmp_path):
    """The plan of the result reads the settled days only, not the raw tables."""
    logs, sensors, weather = tables
    path = str(tmp_path / "logs")
    logs.write.parquet(path)
    daily = D.daily_metrics(logs.sparkSession.read.parquet(path), sensors, weather)
    assert path not in daily._jdf.queryExecution().toString()


def test_run_summary(tables):
    row = A.run_summary(D.daily_metrics(*tables)).first()
    assert (row["days"], row["total_production"], row["mean_production"]) == (4, 160.0, 40.0)
    assert (row["first_date"], row["last_date"]) == (DAYS[0], DAYS[3])


def test_months_without_rows_are_kept(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 3), 1.0), (dt.date(2024, 3, 5), 3.0)], "date date, total_production_daily double")
    rows = [tuple(row) for row in A.monthly_mean(daily).orderBy("month_end").collect()]
    assert rows == [(dt.date(2024, 1, 31), 1.0), (dt.date(2024, 2, 29), None), (dt.date(2024, 3, 31), 3.0)]


def test_all_missing_tons_sum_to_zero(spark):
    logs = spark.createDataFrame([(DAYS[0], None, None)], "date date, tons_extracted double, quality_grade double")
    assert tuple(A.daily_production(logs).first()) == (DAYS[0], 0.0, None)


@pytest.mark.skipif("RECORDS_DUMP" not in os.environ, reason="set RECORDS_DUMP to the dump of the original records")
def test_published_values_of_the_original_records(spark):
    from shiftlode.operators import quality, stats
    from shiftlode.session import settle
    from shiftlode.sources import dump

    logs = dump.read_production_logs(spark, os.environ["RECORDS_DUMP"])
    assert logs.count() == 2190
    assert D.cleaning_report(logs).first()["anomaly_flags"] == ["negative_tons_extracted_91"]
    days = settle(A.daily_production(D.clean_production(logs)))
    row = stats.describe_table(days, [V.TARGET]).first()
    assert (row["count"], round(row["mean"], 6), round(row["std"], 6)) == (365, 1711.737233, 314.648011)
    assert [round(row[name], 2) for name in ("min", "q1", "median", "q3", "max")] == [
        662.71, 1485.32, 1707.46, 1947.26, 2606.82,
    ]
    trend = stats.trend(days).first()
    assert (round(trend["slope"], 6), trend["trend"]) == (0.082481, "stable")
    assert round(quality.table_quality(logs, "production_logs").first()["quality_score"], 4) == 91.6758
    july, august = [row["mean_value"] for row in A.monthly_mean(days).orderBy("month_end").take(2)]
    assert (round(july, 2), round(august, 6)) == (1640.31, 1759.356129)
    first = days.where(F.col("date") == dt.date(2024, 7, 1)).first()
    assert (round(first[V.TARGET], 2), round(first["average_quality_grade"], 2)) == (1483.01, 4.65)
