"""Ordered calculations, sorts and limits."""

from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import filters, models, quality, stats
from shiftlode.operators.ordered import forward_fill, over_previous_rows, with_row_index
from shiftlode.plans import features as X
from shiftlode.registry.aggregation import PREDICTED, line_predictions
from shiftlode.registry.base import ints, num, nums, query
from shiftlode.registry.columns import KEY_COLUMNS, LOG_INTS
from shiftlode.session import settle
from shiftlode.sources import views as W

T = V.TARGET


def indexed_daily(spark, folder):
    return with_row_index(W.stored_daily(spark, folder))


LAG_NAMES = [f"{T}_lag_{k}" for k in V.LAGS]
ROLLING_NAMES = [f"{T}_rolling_{kind}_{n}" for n in V.ROLLING_WINDOWS for kind in ("mean", "std")]
LAG_SQL = ", ".join(f"LAG({T}, {k}) OVER w AS {T}_lag_{k}" for k in V.LAGS)


def rolling_sql(before: str, after: str) -> str:
    """``before`` and ``after`` are the frame bounds for n rows."""
    parts = []
    for n in V.ROLLING_WINDOWS:
        frame = f"(ORDER BY date ROWS BETWEEN {before.format(n=n, m=n - 1)} AND {after})"
        for kind, function in (("mean", "AVG"), ("std", "STDDEV_SAMP")):
            parts.append(
                f"CASE WHEN COUNT({T}) OVER {frame} = {n} THEN {function}({T}) OVER {frame} END "
                f"AS {T}_rolling_{kind}_{n}"
            )
    return ", ".join(parts)


CURRENT = rolling_sql("{m} PRECEDING", "CURRENT ROW")
EARLIER = rolling_sql("{n} PRECEDING", "1 PRECEDING")
WINDOW = "WINDOW w AS (ORDER BY date)"


@query(
    "lag_features",
    f"""WITH l AS (SELECT date, {LAG_SQL} FROM long_daily {WINDOW}) SELECT date, {nums(*LAG_NAMES)} FROM l""",
    "long_daily",
)
def lag_features(spark, folder):
    return X.lag_features(indexed_daily(spark, folder)).select("date", *LAG_NAMES)


@query(
    "rolling_features",
    f"WITH l AS (SELECT date, {CURRENT} FROM long_daily) SELECT date, {nums(*ROLLING_NAMES)} FROM l",
    "long_daily",
)
def rolling_features(spark, folder):
    return X.rolling_features(indexed_daily(spark, folder)).select("date", *ROLLING_NAMES)


@query(
    "rolling_features_before",
    f"WITH l AS (SELECT date, {EARLIER} FROM long_daily) SELECT date, {nums(*ROLLING_NAMES)} FROM l",
    "long_daily",
)
def rolling_features_before(spark, folder):
    """Windows that end the day before."""
    rolling = X.rolling_features(indexed_daily(spark, folder), include_current=False)
    return rolling.select("date", *ROLLING_NAMES)


SHIFT_DAYS = """mine_days AS (SELECT mine_id, date, SUM(tons_extracted) AS tons FROM production_logs GROUP BY 1, 2)"""


@query(
    "lag_features_per_mine",
    f"""WITH {SHIFT_DAYS},
        l AS (SELECT mine_id, date, {', '.join(f'LAG(tons, {k}) OVER w AS lag_{k}' for k in V.LAGS)}
              FROM mine_days WINDOW w AS (PARTITION BY mine_id ORDER BY date))
        SELECT {ints('mine_id')}, date, {nums(*[f'lag_{k}' for k in V.LAGS])} FROM l""",
    "production_logs",
)
def lag_features_per_mine(spark, folder):
    """The same helpers with one series per mine."""
    days = settle(
        W.production_logs(spark, folder).groupBy("mine_id", "date").agg(F.sum("tons_extracted").alias("tons")),
        "mine-days",
    )
    lagged = over_previous_rows(
        with_row_index(days, entity=["mine_id"]),
        lambda w: {f"lag_{k}": F.lag("tons", k).over(w) for k in V.LAGS},
        max(V.LAGS),
        entity=["mine_id"],
    )
    return lagged.select("mine_id", "date", *[f"lag_{k}" for k in V.LAGS])


@query(
    "forward_fill",
    f"""WITH f AS (SELECT date, COALESCE(LAST_VALUE(fuel_efficiency IGNORE NULLS) OVER
            (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 5.0) AS fuel_efficiency FROM long_daily)
        SELECT date, {nums('fuel_efficiency')} FROM f""",
    "long_daily",
)
def forward_fill_query(spark, folder):
    daily = W.stored_daily(spark, folder).select("date", "fuel_efficiency")
    return forward_fill(daily, {"fuel_efficiency": V.DEFAULT_FUEL})


@query(
    "time_index",
    "SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS time_index FROM long_daily",
    "long_daily",
)
def time_index(spark, folder):
    return indexed_daily(spark, folder).select("date", "time_index")


@query(
    "latest_value",
    f"""SELECT date, {nums(*V.METRICS)} FROM long_daily WHERE date = (SELECT MAX(date) FROM long_daily)""",
    "long_daily",
)
def latest_value(spark, folder):
    return stats.latest_values(W.long_daily(spark, folder), V.METRICS)


SPLIT_SQL = """n AS (SELECT COUNT(*) AS n FROM long_daily),
    i AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS split_index FROM long_daily),
    s AS (SELECT date, split_index, CASE WHEN split_index < FLOOR(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END
          AS split FROM i, n)"""


@query("time_split", f"WITH {SPLIT_SQL} SELECT date, split_index, split FROM s", "long_daily")
def time_split(spark, folder):
    return X.time_split(W.stored_daily(spark, folder)).select("date", "split_index", "split")


@query(
    "expanding_folds",
    f"""WITH {SPLIT_SQL},
        t AS (SELECT date, split_index, COUNT(*) OVER () AS n FROM s WHERE split = 'train'),
        f AS (SELECT date, split_index, fold, n - (5 - fold) * (n // 6) AS a, n - (4 - fold) * (n // 6) AS b
              FROM t, RANGE(5) r(fold))
        SELECT date, CAST(fold AS BIGINT) AS fold, CASE WHEN split_index < a THEN 'train' ELSE 'test' END AS role
        FROM f WHERE split_index < b""",
    "long_daily",
)
def expanding_folds(spark, folder):
    split = settle(X.time_split(W.stored_daily(spark, folder)), "split")
    return X.expanding_folds(split.where(F.col("split") == "train")).select("date", "fold", "role")


@query(
    "duplicate_flags",
    f"""SELECT date, {ints('mine_id')}, shift, {LOG_INTS}, ROW_NUMBER() OVER (PARTITION BY date, mine_id, shift
          ORDER BY production_logs.l_orderkey, production_logs.l_linenumber, production_logs.l_partkey) > 1 AS is_duplicate
        FROM production_logs""",
    "production_logs",
)
def duplicate_flags(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS).drop("tons_extracted", "quality_grade")
    return quality.duplicate_flags(logs, V.RULES["production_logs"]["keys"], KEY_COLUMNS)


@query(
    "daily_summary_desc",
    f"""SELECT date, {nums('total_production_daily', 'equipment_utilization', 'weather_impact_score')}
        FROM long_daily""",
    "long_daily",
)
def daily_summary_desc(spark, folder):
    return filters.daily_summary(W.long_daily(spark, folder))


@query(
    "first_n",
    f"""SELECT date, {nums('total_production_daily', 'average_quality_grade')} FROM daily_series
        ORDER BY date LIMIT 10""",
    "daily_series",
)
def first_n(spark, folder):
    return filters.first_n(W.daily_series(spark, folder))


@query(
    "ranked_correlations",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS feature, {num(f'CORR({name}, {T})', 'correlation')} FROM long_daily"
        for name in V.BASE_FEATURES
    ),
    "long_daily",
)
def ranked_correlations(spark, folder):
    return stats.ranked_correlations(W.long_daily(spark, folder))


@query(
    "model_leaderboard",
    f"""{PREDICTED} SELECT model, {', '.join(num(name, f'test_{name}') for name in ('rmse', 'mae', 'r2', 'mape'))}
        FROM e WHERE split = 'test'""",
)
def model_leaderboard(spark, folder):
    return models.model_leaderboard(stats.error_metrics(line_predictions(spark, folder), ["model", "split"]))


@query(
    "best_model",
    f"{PREDICTED} SELECT model, {num('r2', 'test_r2')} FROM e WHERE split = 'test' ORDER BY r2 DESC LIMIT 1",
)
def best_model(spark, folder):
    return models.best_model(stats.error_metrics(line_predictions(spark, folder), ["model", "split"]))


@query(
    "overfit_gap",
    f"""{PREDICTED} SELECT a.model, {num('a.r2', 'train_r2')}, {num('b.r2', 'test_r2')}, {num('a.r2 - b.r2', 'gap')}
        FROM e a JOIN e b ON a.model = b.model AND a.split = 'train' AND b.split = 'test'""",
)
def overfit_gap(spark, folder):
    return models.overfit_gap(stats.error_metrics(line_predictions(spark, folder), ["model", "split"]))
