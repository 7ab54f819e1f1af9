"""Regression models with Spark ML: scaling, estimators, tuning over expanding folds.

The input is the daily feature table (one row per day). Fits run on the executors;
the driver only submits them and keeps parameters and scores. ``tune`` spreads the rows of each fit; linear models are
searched by :func:`search_linear` from moments per fold, taken in one pass over rows of any number; forests and
boosted trees over tables of checked size are searched by ``trees.search``, which spreads the fits.
"""

import itertools
import json
import logging
import math
import random
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import as_double
from shiftlode.operators import moments, trees
from shiftlode.plans.features import fold_block, fold_bounds

log = logging.getLogger(__name__)

SCALED_MODELS = {"Linear_Regression", "Ridge_Regression"}
DEEPEST_TREE = 30
LEAST_SQUARES_ALPHA = 1e-8


@dataclass(frozen=True)
class TrainingSet:
    """Size and label spread of the rows a model is fitted on."""

    rows: int
    label_std: float


def training_set(df: DataFrame, label: str = V.TARGET) -> TrainingSet:
    row = df.agg(F.count("*").alias("rows"), F.stddev_pop(label).alias("std")).first()
    return TrainingSet(row["rows"], row["std"] or 0.0)


def standardize(train: DataFrame, other: DataFrame, names: list[str]) -> DataFrame:
    """z-scores of ``other`` with the mean and population std of ``train``.

    A constant column becomes 0.
    """
    moments = train.agg(
        F.struct(
            *[F.avg(name).alias(f"mean_{name}") for name in names],
            *[F.stddev_pop(name).alias(f"std_{name}") for name in names],
        )
    ).scalar()
    scores = {
        name: F.coalesce(
            F.try_divide(F.col(name) - moments[f"mean_{name}"], moments[f"std_{name}"]), F.lit(0.0)
        )
        for name in names
    }
    return other.withColumns(scores)


def feature_stages(names: list[str], scaled: bool) -> list:
    """Assemble the features; scaled models also centre them and divide by the std."""
    if not scaled:
        return [VectorAssembler(inputCols=names, outputCol="features")]
    return [
        VectorAssembler(inputCols=names, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
    ]


def ridge_regression(alpha: float, data: TrainingSet, scaler_rows: int | None = None) -> LinearRegression:
    """Least squares plus ``alpha`` times the squared length of the coefficients.

    The solver minimises the mean (not the sum) of squares and divides the penalty by the
    std of the label, hence the factor std / rows. ``alpha`` refers to features divided by
    their population std, the scaler uses the sample std: factor (n - 1) / n. A feature
    that is constant within a fold sends the solver to its iterative branch, so that one
    gets a tight tolerance.
    """
    n = scaler_rows or data.rows
    reg = alpha * (n - 1) / n * data.label_std / data.rows
    return LinearRegression(
        labelCol=V.TARGET,
        regParam=reg,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        maxIter=1000,
        tol=1e-8,
    )


def linear_regression(data: TrainingSet) -> LinearRegression:
    """Least squares. The features are collinear over a single year (position, day of
    year and year); a vanishing penalty then picks the shortest solution."""
    return ridge_regression(LEAST_SQUARES_ALPHA, data)


def random_forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1, **_):
    """Every split may use all features; unlimited depth means the deepest Spark allows."""
    return RandomForestRegressor(
        labelCol=V.TARGET,
        numTrees=n_estimators,
        maxDepth=max_depth or DEEPEST_TREE,
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy="all",
        seed=V.SEED,
    )


def gradient_boosting(
    n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3, subsample: float = 1.0
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=V.TARGET,
        maxIter=n_estimators,
        stepSize=learning_rate,
        maxDepth=max_depth,
        subsamplingRate=subsample,
        seed=V.SEED,
    )


def estimator(model: str, params: dict, data: TrainingSet, scaler_rows: int | None = None) -> Estimator:
    if model == "Linear_Regression":
        return linear_regression(data)
    if model == "Ridge_Regression":
        return ridge_regression(params["alpha"], data, scaler_rows)
    if model == "Random_Forest":
        return random_forest(**params)
    if model == "Gradient_Boosting":
        return gradient_boosting(**params)
    raise ValueError(f"unknown model {model}")


def parameter_draws(grid: dict[str, list], draws: int = V.RANDOM_DRAWS, seed: int = V.SEED) -> list[dict]:
    """All combinations for up to two parameters, else that many random ones."""
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if len(grid) <= 2 or len(combinations) <= draws:
        return combinations
    return random.Random(seed).sample(combinations, draws)


@dataclass
class LinearModel:
    """Means and coefficients per feature; a prediction is one expression."""

    model: str
    names: list[str]
    means: list[float]
    coefficients: list[float]
    level: float

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``prediction``, NULL where a feature is missing."""
        parts = [(as_double(F.col(n)) - m) * b for n, m, b in zip(self.names, self.means, self.coefficients)]
        return rows.withColumn("prediction", sum(parts, F.lit(self.level)))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(vars(self)),)], "value string").write.mode("overwrite").text(f"{path}/linear")


def load_linear(spark: SparkSession, path: str) -> LinearModel | None:
    """A stored linear model, or None if there is none at ``path``."""
    try:
        return LinearModel(**json.loads(spark.read.text(f"{path}/linear").first()[0]))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


Fitted = PipelineModel | LinearModel | trees.TreeModel


@dataclass
class Tuned:
    model: str
    params: dict
    fitted: Fitted
    cv_mse: float | None = None
    scores: list[tuple[dict, float]] = field(default_factory=list)
    fits: int | None = None  # fits for the scores, where tree counts share them
    fold_scores: list[tuple[dict, int, float]] = field(default_factory=list)


def tune(
    model: str,
    train: DataFrame,
    names: list[str],
    grid: dict[str, list],
    draws: int = V.RANDOM_DRAWS,
    folds: int = V.FOLDS,
    parallelism: int = 4,
    index: str = "split_index",
) -> Tuned:
    """Pick the parameters with the smallest mean MSE over the folds, refit on all rows.

    The features are scaled once on all train rows, as the folds then see them.
    """
    stages = Pipeline(stages=feature_stages(names, model in SCALED_MODELS)).fit(train)
    rows = training_set(train)
    candidates = parameter_draws(grid, draws)
    scores: list[tuple[dict, float]] = []
    prepared = stages.transform(train).select("features", V.TARGET, index).persist()
    try:
        if len(candidates) > 1:
            bounds = fold_bounds(train, folds).orderBy("fold").collect()
            parts = []
            for bound in bounds:
                fit_rows = prepared.where(F.col(index) < bound["test_start"])
                test_rows = prepared.where(
                    (F.col(index) >= bound["test_start"]) & (F.col(index) < bound["test_end"])
                )
                parts.append((fit_rows, test_rows, training_set(fit_rows)))
            evaluator = RegressionEvaluator(labelCol=V.TARGET, metricName="mse")

            def score(job):
                params, (fit_rows, test_rows, size) = job
                fitted = estimator(model, params, size, rows.rows).fit(fit_rows)
                return evaluator.evaluate(fitted.transform(test_rows))

            jobs = list(itertools.product(candidates, parts))
            pool = ThreadPool(min(parallelism, len(jobs)))
            try:
                results = pool.map(inheritable_thread_target(train.sparkSession)(score), jobs)
            finally:
                pool.close()
            for number, params in enumerate(candidates):
                part = results[number * folds : (number + 1) * folds]
                scores.append((params, sum(part) / folds))
            best, cv_mse = min(scores, key=lambda item: item[1] if not math.isnan(item[1]) else math.inf)
        else:
            best, cv_mse = (candidates or [{}])[0], None
        final = estimator(model, best, rows).fit(prepared)
    finally:
        prepared.unpersist()
    return Tuned(model, best, PipelineModel([*stages.stages, final]), cv_mse, scores)


def search_linear(
    model: str, train: DataFrame, names: list[str], grid: dict[str, list], draws: int = V.RANDOM_DRAWS, folds: int = V.FOLDS
) -> Tuned:
    """As :func:`tune`, for least squares and ridge, from one pass over the features, whatever the folds and penalties.

    The rows before the first test block and every test block have their moments; those of the training rows of
    a fold are running sums of them, and errors on its test rows follow from theirs. The features are divided by their
    deviation over all train rows, as in :func:`tune`. Rows with a missing value take no part.
    Fewer rows than ``folds + 1`` make no folds, so they are an error if there is a penalty to choose.
    """
    candidates = parameter_draws(grid, draws)
    columns = [*names, V.TARGET]
    choose = len(candidates) > 1
    found = moments.collect_moments(train, columns, fold_block(train, folds) if choose else None)
    parts = [found.get(block, moments.Moments.none(columns)) for block in range(-1, folds)] if choose else list(found.values())
    rows = moments.total(parts, columns)
    if rows.rows < (folds + 1 if choose else 1):
        raise ValueError(f"{rows.rows} complete rows are too few")
    scale = rows.std()[:-1]
    fold_scores = []
    if choose:
        earlier = list(itertools.accumulate(parts))
        for params, fold in itertools.product(candidates, range(folds)):
            before, test = earlier[fold], parts[fold + 1]
            fold_scores.append((params, fold, test.squared_error(before.ridge(params["alpha"], scale), before)))
    scores = [
        (params, sum(mse for _, _, mse in fold_scores[number * folds : (number + 1) * folds]) / folds)
        for number, params in enumerate(candidates)
        if choose
    ]
    best, cv_mse = (
        min(scores, key=lambda item: item[1] if not math.isnan(item[1]) else math.inf) if choose else ((candidates or [{}])[0], None)
    )
    coefficients = rows.ridge(best.get("alpha", 0.0), scale)
    fitted = LinearModel(model, list(names), rows.means[:-1].tolist(), np.asarray(coefficients).tolist(), float(rows.means[-1]))
    return Tuned(model, best, fitted, cv_mse, scores, 0, fold_scores)


def search_trees(
    model: str, train: DataFrame, names: list[str], grid: dict[str, list], draws: int = V.RANDOM_DRAWS, folds: int = V.FOLDS
) -> Tuned:
    """As :func:`tune`, for forests and boosted trees over a daily table: the fits are spread, and one serves all tree counts."""
    found = trees.search(model, train, names, parameter_draws(grid, draws), folds)
    return Tuned(model, found.params, found.fitted, found.cv_mse, found.scores, found.fits)


def train_models(
    train: DataFrame, names: list[str], grids: dict[str, dict] | None = None, spread_rows: bool = False, **options
) -> dict[str, Tuned]:
    """Tune and fit every model of ``grids``; one that fails is reported and left out.

    ``spread_rows=True`` fits trees with Spark ML, for tables beyond ``trees.MOST_ROWS``.
    """
    trained = {}
    for model, grid in (V.MODEL_GRIDS if grids is None else grids).items():
        try:
            spread = tune if spread_rows or model not in trees.MODELS else search_trees
            way = search_linear if model in SCALED_MODELS else spread
            trained[model] = way(model, train, names, grid, **options)
        except Exception:
            log.exception("training %s failed, the model is left out", model)
    return trained


def predict(fitted: Fitted, rows: DataFrame, model: str) -> DataFrame:
    """Date, split, actual and predicted value of every row."""
    return fitted.transform(rows).select(
        F.lit(model).alias("model"), "split", "date", F.col(V.TARGET).alias("actual"), "prediction"
    )


def save_model(tuned: Tuned, folder: str) -> str:
    """Store a fitted model together with its scaler stage."""
    path = f"{folder.rstrip('/')}/{tuned.model.lower()}_model"
    if isinstance(tuned.fitted, LinearModel | trees.TreeModel):
        tuned.fitted.save(path)
    else:
        tuned.fitted.write().overwrite().save(path)
    return path


def load_model(path: str) -> Fitted:
    spark = SparkSession.active()
    return load_linear(spark, path) or trees.load_trees(spark, path) or PipelineModel.load(path)


def model_leaderboard(metrics: DataFrame) -> DataFrame:
    """Test metrics per model, best R2 first."""
    return (
        metrics.where(F.col("split") == "test")
        .select("model", *[F.col(name).alias(f"test_{name}") for name in ("rmse", "mae", "r2", "mape")])
        .orderBy(F.desc("test_r2"))
    )


def best_model(metrics: DataFrame) -> DataFrame:
    test = metrics.where(F.col("split") == "test")
    return test.agg(F.max_by("model", "r2").alias("model"), F.max("r2").alias("test_r2"))


def overfit_gap(metrics: DataFrame) -> DataFrame:
    """Train R2 beside test R2 per model."""
    r2 = {split: F.max(F.when(F.col("split") == split, F.col("r2"))) for split in ("train", "test")}
    return (
        metrics.groupBy("model")
        .agg(r2["train"].alias("train_r2"), r2["test"].alias("test_r2"))
        .withColumn("gap", F.col("train_r2") - F.col("test_r2"))
    )
