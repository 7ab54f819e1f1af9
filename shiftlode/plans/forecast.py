"""From the daily table to fitted models and their comparison."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import models as M
from shiftlode.operators import stats
from shiftlode.plans.features import feature_names, feature_table, time_split
from shiftlode.session import settle
from shiftlode.sinks.tables import write_json


@dataclass
class Forecast:
    features: DataFrame
    models: dict[str, M.Tuned]
    predictions: DataFrame
    metrics: DataFrame


def modelling_table(daily: DataFrame, include_current: bool = True) -> DataFrame:
    """Features with position and split, written once for all fits that read it."""
    return settle(time_split(settle(feature_table(daily, include_current), "features")), "modelling")


def run_forecast(
    daily: DataFrame,
    grids: dict[str, dict] | None = None,
    include_current: bool = True,
    **options,
) -> Forecast:
    """Features, time split, tuning, predictions and error metrics of all models.

    ``include_current=True`` keeps the target of the day inside its rolling features, so
    linear models reproduce it exactly; ``False`` uses the days before only.
    """
    table = modelling_table(daily, include_current)
    train = table.where(F.col("split") == "train")
    models = M.train_models(train, feature_names(include_current), grids, **options)
    if not models:
        raise RuntimeError("no model could be trained")
    predictions = reduce(
        DataFrame.unionByName, [M.predict(tuned.fitted, table, name) for name, tuned in models.items()]
    )
    metrics = settle(stats.error_metrics(predictions, ["model", "split"]), "metrics")
    return Forecast(table, models, predictions, metrics)


def save_results(forecast: Forecast, folder: str, include_current: bool = True) -> None:
    """Models, metrics per model and the feature names."""
    folder = folder.rstrip("/")
    for tuned in forecast.models.values():
        M.save_model(tuned, f"{folder}/models")
    wide = forecast.metrics.groupBy("model").pivot("split", ["train", "test"]).agg(
        *[F.first(name).alias(name) for name in ("mse", "rmse", "mae", "r2", "mape")]
    )
    write_json(wide, f"{folder}/results/model_results")
    names = feature_names(include_current)
    spark = forecast.metrics.sparkSession
    write_json(
        spark.createDataFrame(list(enumerate(names)), "position int, feature string"),
        f"{folder}/results/feature_names",
    )


def summary(forecast: Forecast) -> dict[str, DataFrame]:
    return {
        "leaderboard": M.model_leaderboard(forecast.metrics),
        "best": M.best_model(forecast.metrics),
        "overfit_gap": M.overfit_gap(forecast.metrics),
        "rows": forecast.features.agg(
            F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
        ).withColumn("target", F.lit(V.TARGET)),
    }
