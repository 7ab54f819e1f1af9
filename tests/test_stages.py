import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import constraints as C
from shiftlode.plans import daily as D
from shiftlode.plans import validation as P
from shiftlode.plans.stages import extract, run_all, run_etl
from shiftlode.registry.scans import dump_text, typed_logs
from shiftlode.sinks.tables import read_table
from shiftlode.sinks.versions import read_version
from shiftlode.sources import dump, files
from shiftlode.sources import views as W


def land(spark, folder, place, broken: bool) -> list[str]:
    """Dump, CSV and payloads; with records that break every constraint if ``broken``."""
    logs = dump_text(typed_logs(spark, folder), "production_logs")
    lines = dump.insert_lines(W.all_mines(spark, folder), "mines").unionByName(logs)
    payloads = files.payload_lines(W.weather_data(spark, folder))
    sensors = W.equipment_sensors(spark, folder)
    sensors = sensors.withColumn("timestamp", sensors["timestamp"].cast("string"))
    if broken:
        head = "INSERT INTO production_logs (date, mine_id, shift, tons_extracted, quality_grade) VALUES "
        values = ["(NULL, 1, 'Day', 1, 1);", "('2024-01-01', 99999, 'Day', 1, 1);", "('2024-01-01', 1, 'Day');", "('2024-01-01', 1, 'Day', 'x', 1);"]
        lines = lines.unionByName(spark.createDataFrame([(head + v,) for v in values], "value string"))
        sensors = sensors.unionByName(spark.createDataFrame([("2024-01-05 00:00:00", None, "active", 9000.0, False), ("bad", "EQ1", "active", 1.0, True)], sensors.schema))
        bad = '{"latitude":2.0,"longitude":1.0,"timezone":"x","daily":{"time":["2024-13-45"],"temperature_2m_mean":[1.0],"precipitation_sum":[1.0]}}'
        payloads = payloads.unionByName(payloads.limit(1)).unionByName(spark.createDataFrame([(bad,)], "value string"))
    lines.write.text(str(place / "dump"))
    sensors.write.option("header", True).csv(str(place / "sensors"))
    payloads.write.text(str(place / "payloads"))
    return [str(place / name) for name in ("dump", "sensors", "payloads")]


def test_all_stages_from_files(spark, folder, tmp_path):
    """Dump, CSV and payloads in; warehouse, report, panels and models out."""
    sources = extract(spark, *land(spark, folder, tmp_path, False))
    warehouse = str(tmp_path / "warehouse")
    result = run_all(
        spark, sources, warehouse, "2024-01-01", "2024-02-06", grids={"Ridge_Regression": {"alpha": [1.0, 10.0]}}
    )
    tables = result["tables"]
    assert tables["production_logs"].count() == 6000
    assert tables["daily_production_metrics"].count() == 40
    assert set(tables["daily_production_metrics"].columns) == {"id", *V.DAILY_COLUMNS, "created_at"}
    assert result["summary"].first()["days"] == 40
    assert result["report"]["overall"].first()["weather_data_complete"] is True
    assert spark.read.json(f"{warehouse}/validation_report").count() == 1
    assert spark.read.parquet(f"{warehouse}/data_quality_log").count() == 1
    assert result["forecast"].metrics.count() == 2
    stored = read_table(spark, f"{warehouse}/production_logs")
    assert stored.where("tons_extracted < 0").count() > 0  # raw values are kept
    assert tables["rejected_rows"].count() == 0
    for name, column in V.ID_COLUMNS.items():
        ids = tables[name].agg(F.count("*"), F.count(column), F.count_distinct(column)).first()
        assert len(set(ids)) == 1


def test_bad_rows_are_kept_out_and_counted(spark, folder, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    clean = run_etl(spark, extract(spark, *land(spark, folder, good, False)), str(good / "warehouse"))
    dirty = run_etl(spark, extract(spark, *land(spark, folder, bad, True)), str(bad / "warehouse"))
    published = read_version(spark, str(bad / "warehouse"))
    assert {name: (df.columns, df.count()) for name, df in published.items()} == {
        name: (df.columns, df.count()) for name, df in dirty.items()
    }
    found = {(r["table_name"], r["reason"]): r["count"] for r in dirty["rejected_rows"].groupBy("table_name", "reason").count().collect()}
    repeated = found.pop(("weather_data", "duplicate_date"))
    assert repeated > 0
    assert found == {
        ("production_logs", "unreadable"): 2, ("production_logs", "null_date"): 1, ("production_logs", "orphan_mine_id"): 1,
        ("equipment_sensors", "null_timestamp"): 1, ("equipment_sensors", "null_equipment_id"): 1,
        ("weather_data", "null_date"): 1,
    }
    log = {(r["table_name"], r["anomaly_type"]): r["affected_records"] for r in spark.read.parquet(str(bad / "warehouse/data_quality_log")).collect()}
    assert {key: log[key[0], f"rejected_{key[1]}"] for key in found} == found
    columns = [name for name in V.DAILY_COLUMNS if name != "anomaly_flags"]
    assert dirty["daily_production_metrics"].select(columns).exceptAll(clean["daily_production_metrics"].select(columns)).count() == 0
    assert dirty["daily_production_metrics"].count() == 40


def test_reasons_come_in_order(spark):
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (3, None), (3, "c"), (2, "d")], "k int, v string")
    marked = C.with_reason(rows, C.Constraints(("k", "v"), ("v",), {"k": parent}))
    reasons = sorted((r["k"] or 0, r["v"] or "", r["_reason"] or "") for r in marked.collect())
    assert reasons == [
        (0, "b", "null_k"), (1, "a", ""), (1, "a", "duplicate_v"), (2, "d", ""), (3, "", "null_v"), (3, "c", "orphan_k"),
    ]


def test_failing_checks_do_not_stop_the_others(spark, folder):
    logs = W.production_logs(spark, folder)
    tables = {
        "production_logs": logs,
        "weather_data": W.weather_data(spark, folder).drop("date"),
        "equipment_sensors": W.equipment_sensors(spark, folder).withColumn("status", F.raise_error(F.lit("no such file"))),
    }
    rows = {r["table_name"]: r for r in P.validate_tables(tables, "2024-01-01", list(V.RULES)).collect()}
    assert set(rows) == set(V.RULES)
    assert rows["production_logs"]["errors"] == [] and rows["production_logs"]["records_checked"] > 0
    for name in ("weather_data", "equipment_sensors", "daily_production_metrics"):
        assert len(rows[name]["errors"]) == 1 and rows[name]["records_checked"] is None


def test_daily_metrics_scan_each_raw_table_once(spark, folder, tmp_path, monkeypatch):
    """The plans that are written have one scan per raw table; what is returned reads none of them."""
    plans, write = [], DataFrameWriter.parquet

    def noted(writer, path, *args, **named):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, path, *args, **named)

    tables = []
    for name in ("production_logs", "equipment_sensors", "weather_data"):
        getattr(W, name)(spark, folder).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    results = D.daily_with_issues(*tables)
    assert sum(plan.count("FileScan") for plan in plans) == len(tables)
    assert not any(str(tmp_path) in file for result in results for file in result.inputFiles())


def test_quality_scans_a_table_once(spark, folder, tmp_path):
    from shiftlode.operators import quality as Q

    W.production_logs(spark, folder).write.parquet(str(tmp_path / "logs"))
    found = Q.table_quality(spark.read.parquet(str(tmp_path / "logs")), "production_logs")
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# Invented records of three days with the results worked out by hand.
RECORDS = """
INSERT INTO mines (mine_id, mine_code, mine_name, location, operational_status) VALUES (1, 'A', 'North', 'x', 'Active'), (2, 'B', 'South', 'y', 'Active');
INSERT INTO production_logs (date, mine_id, shift, tons_extracted, quality_grade) VALUES
 ('2030-03-01', 1, 'Day', 100.5, 4.0), ('2030-03-01', 2, 'Night', -20, 5.0), ('2030-03-02', 1, 'Day', 50, 12),
 ('2030-03-02', 2, 'Day', 30.25, NULL), ('2030-03-03', 1, 'Night', NULL, 3.5);
"""


def test_values_worked_out_by_hand(spark, tmp_path):
    (tmp_path / "records.sql").write_text(RECORDS)
    (tmp_path / "sensors.csv").write_text(
        "timestamp,equipment_id,status,fuel_consumption,maintenance_alert\n2030-03-02 01:00:00,E1,active,10,False\n"
        "2030-03-02 02:00:00,E1,idle,20,False\n2030-03-02 03:00:00,E2,active,1,True\n"
    )
    (tmp_path / "weather.json").write_text(
        '{"latitude":2.0,"longitude":117.3,"timezone":"Asia/Jakarta","daily":{"time":["2030-03-01","2030-03-02"],'
        '"temperature_2m_mean":[25.0,27.0],"precipitation_sum":[8.0,0.0]}}\n'
    )
    sources = extract(spark, *[str(tmp_path / name) for name in ("records.sql", "sensors.csv", "weather.json")])
    daily = run_etl(spark, sources, str(tmp_path / "warehouse"))["daily_production_metrics"].orderBy("date").collect()
    values = [tuple(row[name] for name in V.DAILY_COLUMNS[1:8]) for row in daily]
    # day 1: rain of 3 mm too much; day 2: two degrees too warm, 75 % mean activity, fuel (15 + 1) / 2; day 3: defaults
    assert [row["date"] for row in daily] == [dt.date(2030, 3, day) for day in (1, 2, 3)]
    expected = [
        (100.5, 4.5, 50.0, None, 94.0, 25.0, 8.0),
        (80.25, 10.0, 75.0, 8 / 80.25, 97.0, 27.0, 0.0),
        (0.0, 3.5, 75.0, 0.0, 98.5, 26.0, 0.0),
    ]
    for got, want in zip(values, expected):
        assert got == pytest.approx(want)
    assert {flag for row in daily for flag in row["anomaly_flags"]} == {"negative_tons_extracted_1", "invalid_quality_grade_1"}
