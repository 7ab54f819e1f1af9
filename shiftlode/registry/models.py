"""Model operators on the features of the long daily series."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import models as M
from shiftlode.operators import stats
from shiftlode.operators import trees as T
from shiftlode.plans import features as X
from shiftlode.plans import forecast as P
from shiftlode.registry.base import num, query
from shiftlode.registry.ordering import CURRENT, EARLIER
from shiftlode.registry.reports import FEATURES, features_sql
from shiftlode.session import new_path, settle
from shiftlode.sources import views as W

SPLIT_FEATURES = f"""WITH f AS ({features_sql(CURRENT, FEATURES, rounded=False)}),
    i AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) - 1 AS split_index, COUNT(*) OVER () AS n FROM f),
    s AS (SELECT *, CASE WHEN split_index < FLOOR(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM i)"""
STANDARDIZED = FEATURES


def table(spark, folder):
    return P.modelling_table(W.stored_daily(spark, folder))


def train_of(rows):
    return rows.where(F.col("split") == "train")


@query(
    "standardize",
    f"""{SPLIT_FEATURES},
        m AS (SELECT {', '.join(f'AVG({n}) AS m_{n}, STDDEV_POP({n}) AS d_{n}' for n in STANDARDIZED)}
              FROM s WHERE split = 'train')
        SELECT date, split, {', '.join(num(f'COALESCE(({n} - m_{n}) / NULLIF(d_{n}, 0), 0)', n) for n in STANDARDIZED)} FROM s, m""",
    "long_daily",
)
def standardize(spark, folder):
    rows = table(spark, folder)
    scaled = M.standardize(train_of(rows), rows, STANDARDIZED)
    return scaled.select("date", "split", *STANDARDIZED)


# Two features without the target of the day, for which the solution can be said in SQL.
PAIR = [f"{V.TARGET}_lag_1", f"{V.TARGET}_lag_7"]
EARLIER_SPLIT = f"""WITH f AS ({features_sql(EARLIER, X.feature_names(False), rounded=False)}),
    i AS (SELECT *, {PAIR[0]} AS x1, {PAIR[1]} AS x2, total_production_daily AS y,
            ROW_NUMBER() OVER (ORDER BY date) - 1 AS split_index, COUNT(*) OVER () AS n FROM f),
    s AS (SELECT *, CASE WHEN split_index < FLOOR(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM i),
    m AS (SELECT AVG(x1) AS a1, AVG(x2) AS a2, STDDEV_POP(x1) AS d1, STDDEV_POP(x2) AS d2, COUNT(*) AS rows
          FROM s WHERE split = 'train'),
    z AS (SELECT date, split, split_index, y, (x1 - a1) / d1 AS z1, (x2 - a2) / d2 AS z2, rows FROM s, m)"""


def ridge_sql(source: str, group: str, alphas: str) -> str:
    """Closed form per alpha and group of ``source`` (z1, z2, y): intercept and coefficients."""
    return f"""t AS (SELECT {group}, COUNT(*) AS k, AVG(z1) AS m1, AVG(z2) AS m2, AVG(y) AS my,
          COUNT(*) * VAR_POP(z1) AS s11, COUNT(*) * VAR_POP(z2) AS s22, COUNT(*) * COVAR_POP(z1, z2) AS s12,
          COUNT(*) * COVAR_POP(z1, y) AS s1y, COUNT(*) * COVAR_POP(z2, y) AS s2y FROM {source} GROUP BY {group}),
        b AS (SELECT {group}, alpha, m1, m2, my,
          ((s22 + alpha) * s1y - s12 * s2y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b1,
          ((s11 + alpha) * s2y - s12 * s1y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b2
          FROM t, (SELECT CAST(UNNEST([{alphas}]) AS DOUBLE) AS alpha) q)"""


ALPHAS = V.MODEL_GRIDS["Ridge_Regression"]["alpha"]
TRAIN_ROWS = "(SELECT 1 AS g, * FROM z WHERE split = 'train') v"
GUESS = "my + b1 * (z1 - m1) + b2 * (z2 - m2)"


def earlier_table(spark, folder):
    return P.modelling_table(W.stored_daily(spark, folder), include_current=False)


LEAK = [f"{V.TARGET}_lag_1", f"{V.TARGET}_lag_2", f"{V.TARGET}_rolling_mean_3"]


@query(
    "linear_regression",
    f"""{SPLIT_FEATURES} SELECT date, split,
          {num(f'3 * {LEAK[2]} - {LEAK[0]} - {LEAK[1]}', 'prediction')} FROM s""",
    "long_daily",
)
def linear_regression(spark, folder):
    """The mean of three days and the two days before give the target, which the fit has to find."""
    rows = table(spark, folder)
    tuned = M.tune("Linear_Regression", train_of(rows), LEAK, {})
    return M.predict(tuned.fitted, rows, tuned.model).select("date", "split", "prediction")


@query(
    "ridge_regression",
    f"""{EARLIER_SPLIT}, {ridge_sql(TRAIN_ROWS, 'g', ', '.join(map(str, ALPHAS)))},
        p AS (SELECT alpha, split, y, {GUESS} AS guess FROM z, b)
        SELECT alpha, split, {num('AVG((y - guess) ** 2) / 1000000', 'mse')}, {num('SQRT(AVG((y - guess) ** 2))', 'rmse')},
          {num('AVG(ABS(y - guess))', 'mae')} FROM p GROUP BY alpha, split""",
    "long_daily",
)
def ridge_regression(spark, folder):
    """Errors for every alpha of the grid, against the closed form."""
    rows = earlier_table(spark, folder)
    parts = []
    for alpha in ALPHAS:
        tuned = M.tune("Ridge_Regression", train_of(rows), PAIR, {"alpha": [alpha]})
        errors = stats.error_metrics(M.predict(tuned.fitted, rows, tuned.model), ["split"])
        parts.append(errors.select(F.lit(float(alpha)).alias("alpha"), "split", F.col("mse") / 1e6, "rmse", "mae"))
    return reduce(DataFrame.union, parts).toDF("alpha", "split", "mse", "rmse", "mae")


def searched_trees(spark, folder, model):
    """The default grid of a model on all features: 20 random draws, five folds; what has to hold of the result."""
    rows = table(spark, folder)
    tuned = M.search_trees(model, train_of(rows), FEATURES, V.MODEL_GRIDS[model])
    predictions = settle(M.predict(tuned.fitted, rows, model), "predictions")
    bounds = predictions.where("split = 'train'").agg(F.min("actual"), F.max("actual"), F.avg("actual")).first()
    inside = F.col("prediction").between(bounds[0], bounds[1])
    error, plain = F.col("actual") - F.col("prediction"), F.col("actual") - F.lit(bounds[2])
    best = min(score for _, score in tuned.scores)
    return predictions.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count_if(inside).alias("inside"),
        (F.sum(error * error) < 0.5 * F.sum(plain * plain)).alias("halves_the_error"),
    ).withColumns(
        {
            "candidates": F.lit(len({str(params) for params, _ in tuned.scores})),
            "fits": F.lit(tuned.fits),
            "chosen_is_best": F.lit(dict((str(p), s) for p, s in tuned.scores)[str(tuned.params)] == best),
        }
    )


def trees_sql(model: str) -> str:
    """Draws that differ only in the number of trees share their fits."""
    draws = M.parameter_draws(V.MODEL_GRIDS[model])
    fits = V.FOLDS * len({tuple(v for name, v in draw.items() if name != "n_estimators") for draw in draws})
    return f"""{SPLIT_FEATURES} SELECT split, COUNT(*) AS rows, COUNT(*) AS inside, TRUE AS halves_the_error,
        CAST({len(draws)} AS BIGINT) AS candidates, CAST({fits} AS BIGINT) AS fits, TRUE AS chosen_is_best FROM s GROUP BY split"""


@query("random_forest", trees_sql("Random_Forest"), "long_daily")
def random_forest(spark, folder):
    """Means of leaves lie within the targets of the training rows."""
    return searched_trees(spark, folder, "Random_Forest")


@query("gradient_boosting", trees_sql("Gradient_Boosting").replace("COUNT(*) AS inside, ", ""), "long_daily")
def gradient_boosting(spark, folder):
    return searched_trees(spark, folder, "Gradient_Boosting").drop("inside")


# Trees of one split have a closed form: of all features and limits, the split with the largest gain.
STUMP_FEATURES = ["day_of_week", "month", "day"]
STUMP_ROUNDS = [1, 2, 4]
STUMP_RATE = 0.5


def stump_round(k: int) -> str:
    """SQL of round ``k``: gains over all values of all features, the best split, what is left of the training rows, the guess for all."""
    return f"""
        g{k} AS (SELECT fold, f, v, SUM(SUM(r)) OVER w AS sl, SUM(COUNT(*)) OVER w AS nl, SUM(SUM(r)) OVER p AS st, SUM(COUNT(*)) OVER p AS nt,
                   LEAD(v) OVER (PARTITION BY fold, f ORDER BY v) AS next_v
                 FROM (SELECT fold, f, x[f] AS v, r FROM r{k - 1}, (SELECT UNNEST(RANGE(1, {len(STUMP_FEATURES) + 1})) AS f) q WHERE learns) u
                 GROUP BY fold, f, v WINDOW w AS (PARTITION BY fold, f ORDER BY v), p AS (PARTITION BY fold, f)),
        b{k} AS (SELECT fold, f, v, sl / nl AS vl, (st - sl) / (nt - nl) AS vr FROM g{k} WHERE next_v IS NOT NULL
                 QUALIFY ROW_NUMBER() OVER (PARTITION BY fold ORDER BY ROUND(sl * sl / nl + (st - sl) * (st - sl) / (nt - nl), 3) DESC, f, v) = 1),
        r{k} AS (SELECT r.fold, split_index, learns, x, y, r.r - {STUMP_RATE} * CASE WHEN x[b.f] <= b.v THEN vl ELSE vr END AS r
                 FROM r{k - 1} r JOIN b{k} b ON b.fold = r.fold)"""


@query(
    "boosted_stumps",
    f"""{EARLIER_SPLIT},
        k AS (SELECT UNNEST(RANGE(0, 5)) AS fold),
        e AS (SELECT fold, rows - (5 - fold) * (rows // 6) AS first, rows - (4 - fold) * (rows // 6) AS stop
              FROM k, (SELECT COUNT(*) AS rows FROM s WHERE split = 'train') q),
        r0 AS (SELECT fold, split_index, split_index < first AS learns, [{', '.join(f'CAST({n} AS DOUBLE)' for n in STUMP_FEATURES)}] AS x, y,
                 y - AVG(y) FILTER (WHERE split_index < first) OVER (PARTITION BY fold) AS r
               FROM s JOIN e ON split_index < stop WHERE split = 'train'),
        {','.join(stump_round(k) for k in range(1, max(STUMP_ROUNDS) + 1))}
        {' UNION ALL '.join(f"SELECT CAST({k} AS BIGINT) AS rounds, CAST(fold AS BIGINT) AS fold, {num('AVG(r * r) / 1000000', 'mse')}, CAST(5 AS BIGINT) AS fits FROM r{k} WHERE NOT learns GROUP BY fold" for k in STUMP_ROUNDS)}""",
    "long_daily",
)
def boosted_stumps(spark, folder):
    """Errors after one, two and four rounds of boosting in every fold, all from five fits."""
    grid = {"n_estimators": STUMP_ROUNDS, "learning_rate": [STUMP_RATE], "max_depth": [1]}
    found = T.search("Gradient_Boosting", train_of(earlier_table(spark, folder)), STUMP_FEATURES, M.parameter_draws(grid))
    rows = [(params["n_estimators"], fold, mse / 1e6, found.fits) for params, fold, mse in found.fold_scores]
    return spark.createDataFrame(rows, "rounds long, fold long, mse double, fits long")


@query(
    "tune",
    f"""{EARLIER_SPLIT},
        k AS (SELECT UNNEST(RANGE(0, 5)) AS fold),
        e AS (SELECT fold, rows - (5 - fold) * (rows // 6) AS first, rows - (4 - fold) * (rows // 6) AS stop
              FROM k, (SELECT MAX(rows) AS rows FROM z) r),
        {ridge_sql("(SELECT e.fold AS g, z.* FROM z JOIN e ON split_index < e.first WHERE split = 'train') v", 'g', ', '.join(map(str, ALPHAS)))},
        p AS (SELECT alpha, fold, AVG((y - ({GUESS})) ** 2) AS mse
              FROM b JOIN e ON b.g = e.fold JOIN z ON split_index >= first AND split_index < stop
              WHERE split = 'train' GROUP BY alpha, fold),
        c AS (SELECT alpha, AVG(mse) AS mse FROM p GROUP BY alpha)
        SELECT alpha, {num('mse / 1000000', 'cv_mse')}, mse = (SELECT MIN(mse) FROM c) AS chosen FROM c""",
    "long_daily",
)
def tune(spark, folder):
    """Mean squared error per alpha over five expanding folds, against the closed form in every fold."""
    tuned = M.search_linear("Ridge_Regression", train_of(earlier_table(spark, folder)), PAIR, V.MODEL_GRIDS["Ridge_Regression"])
    return spark.createDataFrame(
        [(float(params["alpha"]), mse / 1e6, params == tuned.params) for params, mse in tuned.scores],
        "alpha double, cv_mse double, chosen boolean",
    )


@query(
    "ridge_folds",
    f"""{EARLIER_SPLIT},
        k AS (SELECT UNNEST(RANGE(0, 5)) AS fold),
        e AS (SELECT fold, rows - (5 - fold) * (rows // 6) AS first, rows - (4 - fold) * (rows // 6) AS stop
              FROM k, (SELECT MAX(rows) AS rows FROM z) r),
        {ridge_sql("(SELECT e.fold AS g, z.* FROM z JOIN e ON split_index < e.first WHERE split = 'train') v", 'g', ', '.join(map(str, ALPHAS)))}
        SELECT alpha, CAST(fold AS BIGINT) AS fold, {num(f'AVG((y - ({GUESS})) ** 2) / 1000000', 'mse')}
        FROM b JOIN e ON b.g = e.fold JOIN z ON split_index >= first AND split_index < stop
        WHERE split = 'train' GROUP BY alpha, fold""",
    "long_daily",
)
def ridge_folds(spark, folder):
    """The error of every alpha in every fold, all from one pass over the features."""
    tuned = M.search_linear("Ridge_Regression", train_of(earlier_table(spark, folder)), PAIR, V.MODEL_GRIDS["Ridge_Regression"])
    rows = [(float(params["alpha"]), fold, mse / 1e6) for params, fold, mse in tuned.fold_scores]
    return spark.createDataFrame(rows, "alpha double, fold long, mse double")


@query(
    "predict",
    f"""{EARLIER_SPLIT}, {ridge_sql(TRAIN_ROWS, 'g', '0')}
        SELECT 'Linear_Regression' AS model, split, date, {num('y', 'actual')}, {num(GUESS, 'prediction')} FROM z, b""",
    "long_daily",
)
def predict(spark, folder):
    rows = earlier_table(spark, folder)
    tuned = M.tune("Linear_Regression", train_of(rows), PAIR, {})
    return M.predict(tuned.fitted, rows, tuned.model)


@query(
    "save_model",
    f"""{EARLIER_SPLIT}, {ridge_sql(TRAIN_ROWS, 'g', '10')}
        SELECT date, {num(GUESS, 'prediction')} FROM z, b""",
    "long_daily",
)
def save_model(spark, folder):
    """Fitted, stored, loaded again and applied."""
    rows = earlier_table(spark, folder)
    tuned = M.tune("Ridge_Regression", train_of(rows), PAIR, {"alpha": [10.0]})
    loaded: PipelineModel = M.load_model(M.save_model(tuned, new_path(spark, "models")))
    return loaded.transform(rows).select("date", "prediction")


FORECAST_MODELS = ["Linear_Regression", "Ridge_Regression", "Random_Forest", "Gradient_Boosting"]


@query(
    "run_forecast",
    f"""{EARLIER_SPLIT} SELECT model, split, COUNT(*) AS rows, {num('SUM(y)', 'actual')}, split = 'train' AS learned
        FROM s, (SELECT UNNEST({FORECAST_MODELS}) AS model) q GROUP BY model, split""",
    "long_daily",
)
def run_forecast(spark, folder):
    """The comparison of models with their default grids, without the target of the day among the features.

    ``learned``: the error on the training rows is below that of always guessing their mean.
    """
    forecast = P.run_forecast(W.stored_daily(spark, folder), include_current=False)
    rows = settle(forecast.predictions, "predictions")
    mean = rows.where("split = 'train'").agg(F.avg("actual")).first()[0]
    plain = F.avg((F.col("actual") - mean) ** 2)
    counts = rows.groupBy("model", "split").agg(F.count("*").alias("rows"), F.sum("actual").alias("actual"), plain.alias("plain"))
    joined = counts.join(forecast.metrics, ["model", "split"])
    learned = (F.col("mse") < F.col("plain")) & (F.col("split") == "train")
    return joined.select("model", "split", "rows", "actual", learned.alias("learned"))
