"""Check states per folder: equal to a full run, reading only what is new."""

import pytest
from pyspark.sql import functions as F

from shiftlode.operators import quality as Q
from shiftlode.plans import check_states as S
from shiftlode.plans import validation as P
from shiftlode.sources import files

SENSORS = "timestamp timestamp, equipment_id string, status string, fuel_consumption double, maintenance_alert boolean"
LOGS = "date date, mine_id int, shift string, tons_extracted double, quality_grade double"


def logs(spark, first, days):
    """Every day has a repeat, a NULL, a value out of range and a hot key."""
    rows = spark.range(days * 40).select(
        F.date_add(F.lit(first).cast("date"), (F.col("id") / 40).cast("int")).alias("date"),
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise((F.col("id") % 40).cast("int")).alias("mine_id"),
        F.when(F.col("id") % 40 != 7, "Day").alias("shift"),
        F.when(F.col("id") % 40 == 9, -5.0).otherwise(F.col("id") * 1.0 % 900).alias("tons_extracted"),
        F.lit(3.0).alias("quality_grade"),
    )
    return rows


def store(df, path, column):
    df.hint("rebalance", column).write.partitionBy(column).mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def figures(df):
    names = [name for name in Q.table_quality(df.sparkSession.createDataFrame([], LOGS), "production_logs").columns]
    return [row.asDict(recursive=True) for row in df.select(*names).collect()]


def test_a_new_day_is_read_alone(spark, tmp_path, monkeypatch):
    path, states = str(tmp_path / "logs"), str(tmp_path / "states")
    first = store(logs(spark, "2024-05-01", 5), path, "date")
    _, read = S.refresh_states(first, "production_logs", states)
    assert read == [f"2024-05-0{d}" for d in range(1, 6)]
    assert S.refresh_states(first, "production_logs", states)[1] == []
    both = store(logs(spark, "2024-05-06", 1), path, "date")
    seen, plain = [], S.states_of
    monkeypatch.setattr(S, "states_of", lambda df, *rest: seen.append(df) or plain(df, *rest))
    found = S.quality_from_states(both, "production_logs", states)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1 and "2024-05-06" in plan.split("PartitionFilters")[1] and seen[0].count() == 40
    assert figures(found) == figures(Q.table_quality(both, "production_logs"))
    assert found.first().total_records == 240


@pytest.mark.parametrize("since", [None, "2024-05-03", "2024-06-10"])
def test_since_equals_a_full_run(spark, tmp_path, since):
    rows = logs(spark, "2024-05-01", 50)
    by_date = store(rows, str(tmp_path / "by_date"), "date")
    by_month = store(files.with_month(rows, "date"), str(tmp_path / "by_month"), files.MONTH)
    want = figures(Q.table_quality(files.scan_since(rows, since), "production_logs"))
    for df in (by_date, by_month):
        assert figures(S.quality_from_states(df, "production_logs", str(tmp_path / "states"), since)) == want


def test_changed_and_lost_folders(spark, tmp_path):
    path, states = str(tmp_path / "logs"), str(tmp_path / "states")
    S.refresh_states(store(logs(spark, "2024-05-01", 3), path, "date"), "production_logs", states)
    more = store(logs(spark, "2024-05-02", 1), path, "date")
    assert S.refresh_states(more, "production_logs", states)[1] == ["2024-05-02"]
    assert figures(S.quality_from_states(more, "production_logs", states)) == figures(Q.table_quality(more, "production_logs"))
    two = spark.read.schema(more.schema).option("basePath", path).parquet(f"{path}/date=2024-05-01", f"{path}/date=2024-05-02")
    assert figures(S.quality_from_states(two, "production_logs", states)) == figures(Q.table_quality(two, "production_logs"))


def test_other_tests_are_counted_anew(spark, tmp_path):
    df = store(logs(spark, "2024-05-01", 2), str(tmp_path / "logs"), "date")
    rules = {"production_logs": {**Q.rules_for("production_logs"), "ranges": {"tons_extracted": (0, 10)}}}
    states = str(tmp_path / "states")
    S.refresh_states(df, "production_logs", states)
    assert len(S.refresh_states(df, "production_logs", states, rules)[1]) == 2
    assert figures(S.quality_from_states(df, "production_logs", states, rules=rules)) == figures(Q.table_quality(df, "production_logs", rules))


def test_rows_without_a_date_and_no_rows(spark, tmp_path):
    rows = logs(spark, "2024-05-01", 2).withColumn("date", F.when(F.col("mine_id") != 3, F.col("date")))
    df = store(rows, str(tmp_path / "some"), "date")
    states = str(tmp_path / "states")
    assert figures(S.quality_from_states(df, "production_logs", states)) == figures(Q.table_quality(df, "production_logs"))
    since = S.quality_from_states(df, "production_logs", states, "2024-05-01")
    assert figures(since) == figures(Q.table_quality(files.scan_since(df, "2024-05-01"), "production_logs"))
    assert since.first().total_records == 80
    none = spark.read.schema(LOGS).parquet(str(tmp_path / "some")).where("false")
    empty = spark.createDataFrame([], LOGS)
    assert S.refresh_states(empty, "production_logs", states)[1] == [] and none.count() == 0


def test_keys_without_the_date_are_refused(spark, tmp_path):
    df = store(logs(spark, "2024-05-01", 1), str(tmp_path / "logs"), "date")
    rules = {"production_logs": {**Q.rules_for("production_logs"), "keys": ["mine_id"]}}
    with pytest.raises(ValueError, match="two folders"):
        S.refresh_states(df, "production_logs", str(tmp_path / "states"), rules)


def test_validation_with_states(spark, tmp_path):
    sensors = spark.sql(
        "SELECT timestamp_seconds(1717200000 + id * 7200) AS timestamp, CAST(id % 5 AS STRING) AS equipment_id, "
        "IF(id % 9 = 0, 'broken', 'active') AS status, id * 1.0D % 60 AS fuel_consumption, false AS maintenance_alert FROM range(800)"
    )
    assert sensors.schema.simpleString() == spark.createDataFrame([], SENSORS).schema.simpleString()
    tables = {
        "production_logs": store(logs(spark, "2024-05-01", 40), str(tmp_path / "logs"), "date"),
        "equipment_sensors": store(files.with_month(sensors), str(tmp_path / "sensors"), files.MONTH),
    }
    for since in (None, "2024-06-05"):
        plain, kept = (P.validate_tables(tables, since, states=states).orderBy("table_name").collect() for states in (None, str(tmp_path / "states")))
        assert [row.asDict(recursive=True) for row in kept] == [row.asDict(recursive=True) for row in plain]
