import datetime as dt
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shiftlode.plans import daily as D
from shiftlode.session import new_path, settle, shared_folder
from shiftlode.sinks import tables as K


def test_refresh_replaces_and_may_read_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    first = K.full_refresh(spark.range(5).toDF("a"), path)
    assert first.count() == 5
    second = K.full_refresh(K.read_table(spark, path).where("a > 2"), path)
    assert sorted(row["a"] for row in second.collect()) == [3, 4]
    third = K.full_refresh(second.where("a > 3"), path)
    assert [row["a"] for row in third.collect()] == [4]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["slot-a", "slot-b", "versions"]


def test_a_reader_sees_the_old_table_or_the_new_one(spark, tmp_path):
    """The old version can be read until the new one is complete, and its plan after that."""
    path = str(tmp_path / "t")
    old = K.full_refresh(spark.range(5).toDF("a"), path)
    seen = []

    @F.udf("long")
    def slow(value):
        import time

        time.sleep(0.2)
        return value

    def read():
        while not done.is_set():
            seen.append(K.read_table(spark, path).count())

    done = threading.Event()
    reader = threading.Thread(target=read)
    reader.start()
    K.full_refresh(spark.range(0, 9, 1, 3).select(slow("id").alias("a")), path)
    done.set()
    reader.join()
    assert set(seen) <= {5, 9} and 5 in seen
    assert K.read_table(spark, path).count() == 9 and old.count() == 5


def test_left_over_files_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    K.full_refresh(spark.range(5).toDF("a"), path)
    spark.range(7).toDF("a").write.parquet(f"{path}/slot-b")  # a run that broke off before its entry
    assert K.read_table(spark, path).count() == 5
    assert K.full_refresh(spark.range(3).toDF("a"), path).count() == 3


def test_failed_refresh_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    K.full_refresh(spark.range(5).toDF("a"), path)
    with pytest.raises(PySparkException):
        K.full_refresh(spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("a")), path)
    assert K.read_table(spark, path).count() == 5


def test_partitioned_refresh_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("date"), "id"
    )
    table = K.full_refresh(rows, path, partition_by=["date"])
    assert table.columns == ["date", "id"]
    assert table.count() == 1000
    plan = table.where("date >= DATE '2024-01-09'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_quality_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    logs = spark.createDataFrame([(-1.0, 5.0), (2.0, 11.0)], "tons_extracted double, quality_grade double")
    for _ in range(2):
        K.append_quality_log(D.cleaning_issues(logs), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2
    assert rows[0]["description"] == "Found 1 records with negative tons_extracted, replaced with 0"
    assert (rows[0]["severity"], rows[0]["affected_records"]) == ("WARNING", 1)
    assert isinstance(rows[0]["timestamp"], dt.datetime)
    assert len({row["id"] for row in rows}) == 2


def test_no_issue_row_without_negative_tons(spark):
    logs = spark.createDataFrame([(1.0, 11.0)], "tons_extracted double, quality_grade double")
    assert D.cleaning_issues(logs).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_stored_ids_are_unique(spark, tmp_path, partitions):
    df = spark.range(1000).where("id % 3 = 0").repartition(partitions)
    stored = K.full_refresh(K.with_generated_id(df, "key"), str(tmp_path / "t"))
    ids = [row["key"] for row in stored.collect()]
    assert len(ids) == len(set(ids)) == 334 and min(ids) == 1


def test_json_report_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "r")
    K.write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, ARRAY('x') AS c"), path)
    assert spark.read.text(path).first()["value"] == '{"a":1,"b":null,"c":["x"]}'


def test_settle_uses_the_shared_folder(spark):
    df = settle(spark.range(3))
    assert df.count() == 3
    assert shared_folder(spark).split(":")[-1] in df.inputFiles()[0]
    assert new_path(spark, "x") != new_path(spark, "x")
