import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import models as M
from shiftlode.operators import stats
from shiftlode.plans import features as X
from shiftlode.plans import forecast as P
from shiftlode.session import settle

NAMES = X.feature_names()


@pytest.fixture(scope="module")
def daily(spark):
    """365 days without gaps: 352 rows with a full history."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0
    return settle(
        spark.range(365).select(
            F.date_add(F.lit("2024-07-01").cast("date"), F.col("id").cast("int")).alias("date"),
            (F.lit(1500.0) + noise + F.col("id") % 7 * 20).alias("total_production_daily"),
            (F.lit(4.0) + noise / 100).alias("average_quality_grade"),
            (F.lit(60.0) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)) / 10).alias("equipment_utilization"),
            (F.lit(0.01) + noise / 10000).alias("fuel_efficiency"),
            (F.lit(80.0) + F.col("id") % 11).cast("double").alias("weather_impact_score"),
            (F.lit(24.0) + F.col("id") % 5).cast("double").alias("temperature_mean"),
            (F.col("id") % 9).cast("double").alias("precipitation_sum"),
        )
    )


@pytest.fixture(scope="module")
def table(daily):
    return P.modelling_table(daily)


@pytest.fixture(scope="module")
def train(table):
    return table.where("split = 'train'")


def test_feature_list(daily, table):
    assert len(NAMES) == 32
    assert X.feature_table(daily).columns == ["date", V.TARGET, *NAMES]
    assert [name for name in NAMES if name not in X.feature_names(False)] == ["fuel_efficiency", "efficiency_weather"]


def test_rows_split_and_folds(table, train):
    counts = {row["split"]: row["count"] for row in table.groupBy("split").count().collect()}
    assert counts == {"train": 281, "test": 71}
    assert table.agg(F.min("time_index")).first()[0] == 13
    bounds = [tuple(row) for row in X.fold_bounds(train).orderBy("fold").collect()]
    assert bounds == [(0, 51, 97), (1, 97, 143), (2, 143, 189), (3, 189, 235), (4, 235, 281)]


def test_folds_follow_their_bounds(train):
    folds = X.expanding_folds(train).groupBy("fold", "role").agg(
        F.count("*"), F.min("split_index"), F.max("split_index")
    )
    got = {(row[0], row[1]): tuple(row)[2:] for row in folds.collect()}
    for fold in range(5):
        start = 51 + 46 * fold
        assert got[(fold, "train")] == (start, 0, start - 1)
        assert got[(fold, "test")] == (46, start, start + 45)


def test_incomplete_days_are_dropped_after_the_index(daily):
    holes = daily.withColumn("weather_impact_score", F.when(F.col("date") != "2024-08-01", F.col("weather_impact_score")))
    features = X.feature_table(holes)
    assert features.count() == 351
    assert features.agg(F.max("time_index")).first()[0] == 364
    assert tuple(X.removed_rows(holes, features).first()) == (365, 351, 14)


def test_mean_temperature_is_over_all_days(daily):
    mean = daily.agg(F.avg("temperature_mean")).first()[0]
    row = X.feature_table(daily).orderBy("date").first()
    assert row["temp_deviation"] == pytest.approx(abs(row["temperature_mean"] - mean))


def arrays(rows):
    frame = rows.orderBy("date").toPandas()
    return frame[NAMES].to_numpy(float), frame[V.TARGET].to_numpy(float)


def scaled(x, mean, std):
    return (x - mean) / np.where(std == 0, 1, std)


def test_standardize_uses_the_population_std_of_train(table, train):
    x, _ = arrays(train)
    got = M.standardize(train, table, NAMES).orderBy("date").toPandas()[NAMES].to_numpy(float)
    np.testing.assert_allclose(got, scaled(arrays(table)[0], x.mean(0), x.std(0)), atol=1e-9)


def test_least_squares_reproduces_the_target_from_its_own_windows(table, train):
    tuned = M.tune("Linear_Regression", train, NAMES, {})
    for row in stats.error_metrics(M.predict(tuned.fitted, table, "x"), ["model", "split"]).collect():
        assert row["r2"] == pytest.approx(1.0) and row["rmse"] < 1e-4


@pytest.mark.parametrize("alpha", [0.1, 10.0])
def test_ridge_equals_the_closed_form(table, train, alpha):
    x, y = arrays(train)
    z = scaled(x, x.mean(0), x.std(0))
    weights = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    expected = scaled(arrays(table)[0], x.mean(0), x.std(0)) @ weights + y.mean()
    tuned = M.tune("Ridge_Regression", train, NAMES, {"alpha": [alpha]})
    got = M.predict(tuned.fitted, table, "x").orderBy("date").toPandas()["prediction"]
    np.testing.assert_allclose(got, expected, rtol=1e-7)


def test_tuning_equals_the_closed_form_over_the_folds(train):
    x, y = arrays(train)
    z = scaled(x, x.mean(0), x.std(0))
    tuned = M.tune("Ridge_Regression", train, NAMES, V.MODEL_GRIDS["Ridge_Regression"])
    for params, score in tuned.scores:
        errors = []
        for start in range(51, 281, 46):
            zt, yt = z[:start], y[:start]
            centred = zt - zt.mean(0)
            weights = np.linalg.solve(centred.T @ centred + params["alpha"] * np.eye(z.shape[1]), centred.T @ (yt - yt.mean()))
            predicted = (z[start : start + 46] - zt.mean(0)) @ weights + yt.mean()
            errors.append(np.mean((y[start : start + 46] - predicted) ** 2))
        assert score == pytest.approx(np.mean(errors), rel=1e-3)
    assert tuned.params == {"alpha": 0.1}


def test_parameter_draws():
    forest = V.MODEL_GRIDS["Random_Forest"]
    draws = M.parameter_draws(forest)
    assert len(draws) == 20 and draws == M.parameter_draws(forest)
    assert len({json.dumps(draw) for draw in draws}) == 20
    assert M.parameter_draws(V.MODEL_GRIDS["Ridge_Regression"]) == [{"alpha": a} for a in (0.1, 1.0, 10.0, 100.0)]
    assert M.parameter_draws({}) == [{}]


def test_forecast_end_to_end(spark, daily, tmp_path):
    grids = {
        "Linear_Regression": {},
        "Random_Forest": {"n_estimators": [5], "max_depth": [None], "min_samples_leaf": [4]},
        "Gradient_Boosting": {"n_estimators": [5], "learning_rate": [0.1], "max_depth": [3], "subsample": [0.9]},
        "Unknown_Model": {},
    }
    forecast = P.run_forecast(daily, grids)
    assert set(forecast.models) == {"Linear_Regression", "Random_Forest", "Gradient_Boosting"}
    assert forecast.predictions.count() == 3 * 352
    summary = P.summary(forecast)
    board = [row["model"] for row in summary["leaderboard"].collect()]
    assert board[0] == summary["best"].first()["model"] == "Linear_Regression"
    assert all(row["train_r2"] <= 1.0 for row in summary["overfit_gap"].collect())
    P.save_results(forecast, str(tmp_path))
    loaded = M.load_model(str(tmp_path / "models" / "random_forest_model"))
    again = loaded.transform(forecast.features).agg(F.sum("prediction")).first()[0]
    before = forecast.predictions.where("model = 'Random_Forest'").agg(F.sum("prediction")).first()[0]
    assert again == pytest.approx(before)
    names = spark.read.json(str(tmp_path / "results" / "feature_names")).orderBy("position")
    assert [row["feature"] for row in names.collect()] == NAMES
    assert spark.read.json(str(tmp_path / "results" / "model_results")).count() == 3
