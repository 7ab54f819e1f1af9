"""Every registered query against its SQL in DuckDB."""

import compare
import pytest

import __spark_entry__ as entry_point

ORACLES = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, folder, connection, name):
    assert compare.difference(QUERIES[name](spark, folder), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry_gives_the_daily_table(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 40
    first = min(rows, key=lambda row: row["date"])
    assert (first["total_production_daily"], first["average_quality_grade"]) == (3304.0, 5.723239)
    assert (first["equipment_utilization"], first["fuel_efficiency"]) == (50.0, None)
    assert (first["weather_impact_score"], first["temperature_mean"], first["precipitation_sum"]) == (96.35, 26.1, 6.0)
