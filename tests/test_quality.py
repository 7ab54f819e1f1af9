import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import joins as J
from shiftlode.operators import quality as Q

D1, D2 = dt.date(2024, 7, 1), dt.date(2024, 7, 2)
LOGS = "date date, mine_id int, shift string, tons_extracted double, quality_grade double"


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(
        [
            (D1, 1, "Day", -5.0, 4.0),
            (D1, 1, "Day", 1000.0, 10.0),
            (D1, 1, "Night", 1000.5, 10.5),
            (D2, None, None, None, -1.0),
            (D2, None, None, float("nan"), 0.0),
        ],
        LOGS,
    )


def counts(df):
    return {row[0]: row[1] for row in df.collect()}


def test_null_counts_include_nan(logs):
    assert counts(Q.null_counts(logs)) == {"mine_id": 2, "shift": 2, "tons_extracted": 2}


def test_range_bounds_are_inclusive_and_null_is_inside(spark, logs):
    clean = logs.withColumn("tons_extracted", F.nanvl("tons_extracted", F.lit(None)))
    assert counts(Q.out_of_range_counts(clean, "production_logs")) == {"tons_extracted": 2, "quality_grade": 2}


def test_missing_status_is_invalid(spark):
    sensors = spark.createDataFrame([("active",), ("idle",), ("broken",), (None,)], "status string")
    assert counts(Q.invalid_value_counts(sensors, "equipment_sensors")) == {"status": 2}


def test_duplicates_treat_missing_keys_as_equal(logs):
    assert Q.duplicate_count(logs, ["date", "mine_id", "shift"]).first()[0] == 2


def test_duplicates_of_whole_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert Q.duplicate_count(rows).first()[0] == 1
    assert Q.duplicate_count(rows.limit(0)).first()[0] == 0


@pytest.mark.parametrize("salts", [1, 4, 64])
def test_duplicate_flags_with_a_hot_key(spark, salts):
    """One key, the missing one, holds half of the rows and many keys occur once;
    exactly one row per key is not a duplicate."""
    key = F.when(F.col("id") % 2 == 1, F.when(F.col("id") < 1000, F.col("id") % 50).otherwise(F.col("id")))
    rows = spark.range(0, 2000, 1, 8).select(key.alias("k"), "id")
    flagged = Q.duplicate_flags(rows, ["k"], ["id"], salts).toPandas().fillna({"k": -1})
    firsts = flagged[~flagged.is_duplicate].set_index("k").id.to_dict()
    assert len(flagged) == 2000
    assert firsts == flagged.groupby("k").id.min().to_dict()


def test_duplicate_flags_of_full_copies(spark):
    copies = spark.range(0, 300, 1, 4).select(F.lit(1).alias("k"), F.lit("same").alias("o"))
    assert Q.duplicate_flags(copies, ["k"], ["o"]).where("NOT is_duplicate").count() == 1


def test_only_firsts_are_shuffled_again(spark):
    """One scan and one shuffle of all rows; the second window reads the firsts of the groups only."""
    rows = spark.range(0, 5000, 1, 4).select((F.col("id") % 10).alias("k"), "id")
    flagged = Q.duplicate_flags(rows, ["k"], ["id"], 8)
    logical = [line.strip(" +-:") for line in flagged._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    second = next(i for i, line in enumerate(logical) if line.startswith("Window") and "_salt" not in line.split("],")[1])
    assert any(line.startswith("Filter") and "NOT _behind" in line for line in logical[second + 1 : second + 3])
    assert flagged.where("NOT is_duplicate").count() == 10
    flagged.collect()
    final = flagged._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert final.count("Range (0, 5000") == 1 and "ReusedExchange" in final


def test_table_quality_scores(spark, logs):
    clean = logs.withColumn("tons_extracted", F.nanvl("tons_extracted", F.lit(None)))
    row = Q.table_quality(clean, "production_logs").first()
    assert (row["records_checked"], row["null_total"], row["out_of_range_total"], row["duplicate_counts"]) == (5, 6, 4, 2)
    # nulls 120 % -> 20, ranges 80 % -> 30, duplicates 40 % -> 12, two kinds -> 10
    assert row["quality_score"] == pytest.approx(100 - 20 - 30 - 12 - 10)
    assert row["null_counts"] == {"mine_id": 2, "shift": 2, "tons_extracted": 2}
    assert row["out_of_range_counts"] == {"tons_extracted": 2, "quality_grade": 2}
    assert [tuple(entry)[:4] for entry in row["anomalies"]] == [
        ("out_of_range", "tons_extracted", 2, "0-1000"),
        ("out_of_range", "quality_grade", 2, "0-10"),
    ]
    assert row["recommendations"] == [
        V.ADVICE_NULLS, V.ADVICE_RANGES, V.ADVICE_DUPLICATES, V.ADVICE_SCORE_90, V.ADVICE_SCORE_70,
    ]


def test_invalid_values_are_an_anomaly_but_not_a_range_issue(spark):
    sensors = spark.createDataFrame(
        [(dt.datetime(2024, 7, 1, hour), "EQ1", "broken", 1.0, False) for hour in range(4)],
        "timestamp timestamp_ntz, equipment_id string, status string, fuel_consumption double, maintenance_alert boolean",
    )
    row = Q.table_quality(sensors, "equipment_sensors").first()
    assert (row["out_of_range_total"], row["anomaly_kinds"], row["quality_score"]) == (0, 1, 95.0)
    assert row["anomalies"][0]["allowed_values"] == ["active", "idle", "maintenance"]
    assert row["recommendations"] == []


def test_empty_table_keeps_full_score(spark):
    row = Q.table_quality(spark.createDataFrame([], LOGS), "production_logs").first()
    assert (row["records_checked"], row["quality_score"], row["recommendations"], row["anomalies"]) == (0, 100.0, [], [])


def test_table_without_rules(spark):
    row = Q.table_quality(spark.createDataFrame([(1,), (1,)], "a int"), "mines").first()
    assert (row["duplicate_counts"], row["quality_score"]) == (1, 85.0)


def test_score_stays_between_10_and_100(spark):
    df = spark.range(50).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(500)).alias(f"c{i}") for i in range(4)], F.lit(10).alias("n"))
    score = Q.quality_score(F.col("c0"), F.col("c1"), F.col("c2"), F.col("c3"), F.col("n"))
    low, high = df.select(score.alias("s")).agg(F.min("s"), F.max("s")).first()
    assert 10.0 <= low <= high <= 100.0


def test_structure_names_missing_columns(spark, logs):
    row = Q.table_structure(logs.drop("shift"), "production_logs").first()
    assert (row["structure_valid"], row["missing_fields"], row["total_records"]) == (False, ["shift"], 5)
    assert Q.table_structure(logs, "production_logs").first()["structure_valid"] is True


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_orphans_both_ways(spark, threshold):
    child = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("k"), "id")
    child = child.unionByName(spark.createDataFrame([(None, 5000)], "k long, id long"))
    parent = spark.createDataFrame([(0,), (1,), (1,), (2,)], "k long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = J.orphan_rows(child, parent, "k")
    expected = {(r["k"], r["id"]) for r in child.collect() if r["k"] is not None and r["k"] not in (0, 1, 2)}
    got = [(r["k"], r["id"]) for r in rows.collect()]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == len(expected) and set(got) == expected
    assert counts(J.orphan_keys(child, parent, "k"))[7] == 334


def test_unique_and_not_null_violations(logs):
    assert J.unique_violations(logs, ["date", "mine_id", "shift"]).count() == 2
    assert counts(Q.not_null_violations(logs, V.NOT_NULL["production_logs"])) == {"date": 0, "mine_id": 2, "shift": 2}
