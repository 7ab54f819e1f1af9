import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftlode import schemas
from shiftlode.sources import dump, files
from shiftlode.sources import views as W

MINE = "INSERT INTO mines (mine_id, mine_code, mine_name, location, operational_status) VALUES "
LOG = "INSERT INTO production_logs (date, mine_id, shift, tons_extracted, quality_grade) VALUES "
LINES = [
    "CREATE TABLE IF NOT EXISTS mines (",
    "    mine_id INT PRIMARY KEY",
    ");",
    "-- INSERT INTO mines is explained here",
    f"{MINE}(1, 'M1', 'North', 'Field 7, East', 'Active');",
    f"{MINE}(2, 'M2', 'Driver''s (old) pit', 'Field 8', NULL);",
    f"{LOG}('2024-07-01', 1, 'Day', -12.5, 7.5);",
    f"{LOG}('2024-07-01',2,'Night',NULL,6.0);",
    "",
]


@pytest.fixture(scope="module")
def dump_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "records.sql"
    path.write_text("\n".join(LINES))
    return str(path)


def test_dump_keeps_commas_quotes_and_nulls(spark, dump_path):
    rows = dump.read_mines(spark, dump_path).orderBy("mine_id").collect()
    assert [tuple(row) for row in rows] == [
        (1, "M1", "North", "Field 7, East", "Active"),
        (2, "M2", "Driver's (old) pit", "Field 8", None),
    ]


def test_dump_logs_are_typed(spark, dump_path):
    logs = dump.read_production_logs(spark, dump_path)
    assert dict(logs.dtypes)["tons_extracted"] == "double"
    rows = [tuple(row) for row in logs.orderBy("mine_id").collect()]
    assert rows == [(dt.date(2024, 7, 1), 1, "Day", -12.5, 7.5), (dt.date(2024, 7, 1), 2, "Night", None, 6.0)]


def test_dump_lines_round_trip(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1, "It's, fine", Decimal("1.50"), None), (None, None, None, Decimal("-3.00"), Decimal("9.9"))],
        schemas.PRODUCTION_LOGS,
    )
    again = dump.parse_inserts(dump.insert_lines(df, "production_logs"), "production_logs", schemas.PRODUCTION_LOGS)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


STATEMENTS = f"""-- two on a line, a comment behind; another
{MINE}(1, 'A', 'one', 'x', 'Active'); {MINE}(2, 'B', 'two', 'x', 'Active'); -- don't stop; here
/* INSERT INTO mines (mine_id) VALUES (99); */
insert into Mines
  (mine_id, mine_code, mine_name, location, operational_status)
VALUES
  (3, 'C', 'semi;colon', 'a (b), c', NULL),
  (4, 'D', 'it''s -- no comment', '', 'Active') -- the last
;
INSERT INTO other (text) VALUES ('INSERT INTO mines (mine_id) VALUES (98);');
INSERT INTO mines VALUES (5, 'E', 'no names', 'x', 'Active');
{MINE}(6, 'F', 'too few', 'x');
{MINE}(7, 'G', 'too many', 'x', 'Active', 1);
{MINE}('eight', 'H', 'no number', 'x', 'Active');
{MINE}(9, 'I', NOW(), 'x', 'Active');
INSERT INTO mines (mine_id, mine_name) VALUES (10, 'other columns');
INSERT INTO mines_archive VALUES (97, 'Z', 'another table', 'x', 'Active');
{MINE}(11, 'K', 'cut off
"""


def test_every_statement_is_read_or_kept_as_reject(spark, tmp_path):
    path = tmp_path / "statements.sql"
    path.write_text(STATEMENTS)
    records = dump.mine_records(spark, str(path))
    rows = dump.accepted(records).orderBy("mine_id").collect()
    assert [tuple(row) for row in rows] == [
        (1, "A", "one", "x", "Active"),
        (2, "B", "two", "x", "Active"),
        (3, "C", "semi;colon", "a (b), c", None),
        (4, "D", "it's -- no comment", "", "Active"),
        (5, "E", "no names", "x", "Active"),
    ]
    kept = [row["record"] for row in dump.rejects(records, "mines").collect()]
    assert len(kept) == 6
    for text in ("too few", "too many", "eight", "NOW()", "other columns", "cut off"):
        assert sum(text in record for record in kept) == 1


def test_other_line_ends(spark, tmp_path):
    path = tmp_path / "windows.sql"
    path.write_bytes(f"{MINE}(1, 'A', 'one', 'x', 'Active');\r\n{MINE}(2, 'B', 'two', 'x', 'Active');\r\n".encode())
    for end in (dump.STATEMENT_END, ";\r\n"):
        pieces = dump.read_statements(spark, str(path), end)
        assert dump.parse_inserts(pieces, "mines", schemas.MINES).count() == 2


def test_sensor_csv(spark, tmp_path):
    path = tmp_path / "sensors.csv"
    path.write_text(
        "timestamp,equipment_id,status,fuel_consumption,maintenance_alert\n"
        "2024-07-01 00:00:00,EQ1,active,12.5,False\n"
        "2024-07-01T01:30:00,EQ2,idle,,True\n"
        "broken,EQ3,,NaN,0\n"
        "2024-07-01 02:00:00,EQ4,idle,many,maybe\n"
    )
    rows = files.read_sensor_csv(spark, str(path)).orderBy("equipment_id").collect()
    assert [tuple(row) for row in rows] == [
        (dt.datetime(2024, 7, 1), "EQ1", "active", 12.5, False),
        (dt.datetime(2024, 7, 1, 1, 30), "EQ2", "idle", None, True),
        (None, "EQ3", None, None, False),
        (dt.datetime(2024, 7, 1, 2), "EQ4", "idle", None, None),
    ]


def test_weather_payloads(spark, tmp_path):
    path = tmp_path / "payloads.json"
    path.write_text(
        '{"latitude":2.0,"longitude":117.3,"timezone":"Asia/Jakarta","daily":{"time":["2024-07-01","2024-07-02"],'
        '"temperature_2m_mean":[27.1,null],"precipitation_sum":[3.0,0.5]}}\n'
        '{"latitude":2.0,"longitude":117.3,"timezone":"Asia/Jakarta","daily":{"time":[],'
        '"temperature_2m_mean":[],"precipitation_sum":[]}}\n'
        '{"error":true,"reason":"no data"}\n'
        "not json\n"
    )
    rows = files.read_weather_payloads(spark, str(path)).orderBy("date").collect()
    assert [tuple(row) for row in rows] == [
        (dt.date(2024, 7, 1), 2.0, 117.3, 27.1, 3.0, "Asia/Jakarta"),
        (dt.date(2024, 7, 2), 2.0, 117.3, None, 0.5, "Asia/Jakarta"),
    ]


def test_defaults_only_where_the_day_is_absent(spark):
    days = files.calendar_between(spark, "2024-07-01", "2024-07-03")
    weather = spark.createDataFrame(
        [(dt.date(2024, 7, 2), 1.0, 2.0, None, None, None)], schemas.WEATHER_DATA
    )
    rows = files.weather_with_defaults(days, weather).orderBy("date").collect()
    assert [tuple(row)[1:] for row in rows] == [
        (2.0167, 117.3, 26.0, 0.0, "Asia/Jakarta"),
        (1.0, 2.0, None, None, None),
        (2.0167, 117.3, 26.0, 0.0, "Asia/Jakarta"),
    ]


def test_calendar_of_one_day_and_of_nothing(spark):
    assert files.calendar_between(spark, "2024-02-29", "2024-02-29").count() == 1
    empty = spark.createDataFrame([(None, None)], "min_date date, max_date date")
    assert files.calendar(empty).count() == 0


def test_columns_of(spark, dump_path):
    rows = files.columns_of(spark, {"mines": dump.read_mines(spark, dump_path)}).orderBy("position").collect()
    assert [row["column_name"] for row in rows] == schemas.MINES.names


def test_filters_and_columns_reach_the_scan(spark, tmp_path, folder):
    """Date filters are pushed down and only the wanted columns are read."""
    path = str(tmp_path / "logs")
    W.production_logs(spark, folder).write.parquet(path)
    logs = spark.read.parquet(path)
    plan = files.scan_since(logs, "2024-01-10").select("tons_extracted")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-10)" in plan
    assert "quality_grade" not in plan

    path = str(tmp_path / "sensors")
    W.equipment_sensors(spark, folder).write.parquet(path)
    sensors = spark.read.parquet(path)
    filtered = files.scan_since(sensors, "2024-01-15", "timestamp")
    assert "GreaterThanOrEqual(timestamp,2024-01-15" in filtered._jdf.queryExecution().executedPlan().toString()
    assert filtered.where(F.to_date("timestamp") < "2024-01-15").count() == 0
