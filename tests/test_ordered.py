"""Ordered helpers against pandas, with blocks small enough that borders matter."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftlode.operators.ordered import forward_fill, over_previous_rows, with_row_index
from shiftlode.plans.features import lag_columns, rolling_columns

T = "total_production_daily"


@pytest.fixture(scope="module")
def frame():
    """Two series with gaps between dates and missing values."""
    pick = random.Random(7)
    rows = []
    for entity in ("a", "b"):
        day = dt.date(2023, 1, 1)
        for _ in range(150):
            day += dt.timedelta(days=pick.choice([1, 1, 1, 2, 45]))
            rows.append((entity, day, None if pick.random() < 0.1 else round(pick.uniform(0, 100), 2)))
    pick.shuffle(rows)
    return pd.DataFrame(rows, columns=["entity", "date", T])


@pytest.fixture(scope="module")
def series(spark, frame):
    return spark.createDataFrame(
        [tuple(None if value != value else value for value in row) for row in frame.itertuples(index=False)],
        f"entity string, date date, {T} double",
    ).repartition(5)


def test_rows_without_a_date_are_kept(spark):
    rows = [(dt.date(2024, 1, d), float(d)) for d in range(1, 6)] + [(None, 7.0), (None, None)]
    df = spark.createDataFrame(rows, f"date date, {T} double")
    indexed = with_row_index(df)
    lagged = over_previous_rows(indexed, lambda w: lag_columns(w, lags=(1,)), 1, block_rows=2).collect()
    got = sorted((r["date"] is None, r["date"], r["time_index"], r[f"{T}_lag_1"]) for r in lagged if r["date"])
    assert [r[2:] for r in got] == [(0, None), (1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    assert [(r["time_index"], r[f"{T}_lag_1"]) for r in lagged if r["date"] is None] == [(None, None)] * 2
    filled = forward_fill(df, {T: 9.0}).where("date IS NULL").collect()
    assert sorted(r[T] for r in filled) == [7.0, 9.0]


def test_index_without_entity(spark, series, frame):
    one = series.where("entity = 'a'")
    got = with_row_index(one).orderBy("date").toPandas()
    assert got["time_index"].tolist() == list(range(150))
    assert got["date"].tolist() == sorted(frame[frame.entity == "a"].date)


def test_index_per_entity(series):
    got = with_row_index(series, entity=["entity"]).toPandas()
    for _, part in got.groupby("entity"):
        assert part.sort_values("date")["time_index"].tolist() == list(range(150))


@pytest.mark.parametrize("block_rows", [14, 16, 37, 4096])
@pytest.mark.parametrize("include_current", [True, False])
def test_windows_across_blocks(series, frame, block_rows, include_current):
    indexed = with_row_index(series, entity=["entity"])
    got = over_previous_rows(
        indexed,
        lambda w: {**lag_columns(w), **rolling_columns(w, include_current=include_current)},
        14,
        entity=["entity"],
        block_rows=block_rows,
    ).toPandas()
    assert len(got) == len(frame)
    for entity, part in got.groupby("entity"):
        part = part.sort_values("date").reset_index(drop=True)
        target = frame[frame.entity == entity].sort_values("date").reset_index(drop=True)[T]
        for k in (1, 2, 3, 7):
            pd.testing.assert_series_equal(part[f"{T}_lag_{k}"], target.shift(k), check_names=False)
        base = target if include_current else target.shift(1)
        for n in (3, 7, 14):
            for kind in ("mean", "std"):
                expected = getattr(base.rolling(n), kind)()
                pd.testing.assert_series_equal(
                    part[f"{T}_rolling_{kind}_{n}"], expected, check_names=False, rtol=1e-9, atol=1e-9
                )


def test_blocks_smaller_than_the_lookback_are_refused(series):
    with pytest.raises(ValueError):
        over_previous_rows(with_row_index(series), lambda w: {}, 14, block_rows=13)


@pytest.mark.parametrize("block", ["month", "single rows"])
def test_forward_fill(series, frame, block):
    expression = None if block == "month" else F.col("date")
    got = forward_fill(series, {T: -1.0}, entity=["entity"], block=expression).toPandas()
    for entity, part in got.groupby("entity"):
        expected = frame[frame.entity == entity].sort_values("date").reset_index(drop=True)[T].ffill().fillna(-1.0)
        assert part.sort_values("date")[T].tolist() == expected.tolist()


def test_fill_of_a_series_without_any_value(spark):
    days = spark.sql("SELECT DATE '2024-01-31' + CAST(id AS INT) AS date, CAST(NULL AS DOUBLE) AS x FROM RANGE(3)")
    assert {row["x"] for row in forward_fill(days, {"x": 50.0}).collect()} == {50.0}


def test_empty_series(spark):
    empty = spark.createDataFrame([], f"date date, {T} double")
    assert with_row_index(empty).count() == 0
    assert forward_fill(empty, {T: 1.0}).count() == 0


def test_no_window_runs_over_the_rows_in_one_task(series):
    """Only the table with one row per block may come together."""
    plan = with_row_index(series)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("_rows" in line for line in windows) == 1
    assert all("_block" in line for line in windows)
