"""Aggregations and statistics."""

from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import aggregates as A
from shiftlode.operators import filters, moments, quality, stats
from shiftlode.plans import daily as D
from shiftlode.registry.base import num, nums, query
from shiftlode.registry.scans import SUMMARY, fixture_daily
from shiftlode.sources import views as W


@query(
    "daily_production",
    f"SELECT date, {nums('total_production_daily', 'average_quality_grade')} FROM production_days",
    "production_days",
)
def daily_production(spark, folder):
    return A.daily_production(D.clean_production(W.production_logs(spark, folder)))


@query(
    "equipment_daily",
    f"SELECT date, equipment_id, {nums('utilization', 'fuel_consumption')} FROM equipment_daily",
    "equipment_daily",
)
def equipment_daily(spark, folder):
    return A.equipment_daily(W.equipment_sensors(spark, folder))


@query(
    "equipment_metrics",
    f"SELECT date, {nums('equipment_utilization', 'avg_fuel_consumption')} FROM equipment_days",
    "equipment_days",
)
def equipment_metrics(spark, folder):
    return D.equipment_days(W.equipment_sensors(spark, folder))


@query(
    "weather_vs_production",
    f"""SELECT {num('precipitation_sum', 'precipitation_sum')}, {num('AVG(total_production_daily)', 'avg_production')}
        FROM long_daily GROUP BY long_daily.precipitation_sum""",
    "long_daily",
)
def weather_vs_production(spark, folder):
    return A.weather_vs_production(W.long_daily(spark, folder))


@query(
    "status_distribution",
    f"""SELECT status, COUNT(*) AS readings, {num('AVG(fuel_consumption)', 'avg_fuel')}
        FROM equipment_sensors GROUP BY status""",
    "equipment_sensors",
)
def status_distribution(spark, folder):
    return A.status_distribution(W.equipment_sensors(spark, folder))


@query("count_rows", "SELECT COUNT(*) AS total FROM production_logs", "production_logs")
def count_rows(spark, folder):
    return A.count_rows(W.production_logs(spark, folder))


@query("date_bounds", "SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM production_logs", "production_logs")
def date_bounds(spark, folder):
    return A.date_bounds(W.production_logs(spark, folder))


@query("run_summary", f"{SUMMARY} FROM daily_metrics", "daily_metrics")
def run_summary(spark, folder):
    return A.run_summary(fixture_daily(spark, folder))


@query(
    "null_counts",
    """SELECT 'fuel_consumption' AS column_name, COUNT(*) AS null_count
       FROM equipment_sensors WHERE fuel_consumption IS NULL HAVING COUNT(*) > 0""",
    "equipment_sensors",
)
def null_counts(spark, folder):
    return quality.null_counts(W.equipment_sensors(spark, folder))


@query(
    "out_of_range_counts",
    """SELECT 'tons_extracted' AS column_name, COUNT(*) AS out_of_range FROM production_logs
         WHERE tons_extracted < 0 OR tons_extracted > 1000
       UNION ALL
       SELECT 'quality_grade', COUNT(*) FROM production_logs WHERE quality_grade < 0 OR quality_grade > 10""",
    "production_logs",
)
def out_of_range_counts(spark, folder):
    return quality.out_of_range_counts(W.production_logs(spark, folder), "production_logs")


@query(
    "invalid_value_counts",
    """SELECT 'status' AS column_name, COUNT(*) AS invalid FROM equipment_sensors
       WHERE status IS NULL OR status NOT IN ('active', 'idle', 'maintenance')""",
    "equipment_sensors",
)
def invalid_value_counts(spark, folder):
    return quality.invalid_value_counts(W.equipment_sensors(spark, folder), "equipment_sensors")


@query(
    "duplicate_count",
    """SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_count
       FROM (SELECT COUNT(*) AS n FROM production_logs GROUP BY date, mine_id, shift) g""",
    "production_logs",
)
def duplicate_count(spark, folder):
    return quality.duplicate_count(W.production_logs(spark, folder), V.RULES["production_logs"]["keys"])


@query(
    "duplicate_count_rows",
    """SELECT CAST((SELECT COUNT(*) FROM lineitem)
         - (SELECT COUNT(*) FROM (SELECT DISTINCT l_suppkey, l_quantity, l_discount FROM lineitem) d) AS BIGINT)
         AS duplicate_count""",
)
def duplicate_count_rows(spark, folder):
    """Without keys the whole row counts."""
    rows = W.table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", "l_discount")
    return quality.duplicate_count(rows)


@query(
    "distinct_dates",
    """SELECT DISTINCT date FROM production_logs WHERE date >= DATE '2024-01-05' AND date <= DATE '2024-01-31'""",
    "production_logs",
)
def distinct_dates(spark, folder):
    return filters.date_range(W.production_logs(spark, folder), "2024-01-05", "2024-01-31").select("date").distinct()


def stats_sql(table: str, metrics: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric, COUNT(*) AS n, AVG({name}) AS mean, STDDEV_SAMP({name}) AS std, "
        f"QUANTILE_CONT({name}, 0.25) AS q1, QUANTILE_CONT({name}, 0.75) AS q3, MIN({name}) AS min, "
        f"MAX({name}) AS max FROM {table}"
        for name in metrics
    )


@query(
    "metric_stats",
    f"""WITH s AS ({stats_sql('long_daily', V.METRICS)})
        SELECT metric, {nums('mean', 'std', 'q1', 'q3')}, {num('q3 - q1', 'iqr')}, {nums('min', 'max')}
        FROM s WHERE n >= 7""",
    "long_daily",
)
def metric_stats(spark, folder):
    return stats.metric_stats(W.long_daily(spark, folder))


TREND_SQL = """i AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) - 1 AS x FROM {table}),
    t AS (SELECT COUNT(*) AS n, REGR_SLOPE(total_production_daily, x) AS slope, AVG(total_production_daily) AS mean
          FROM i),
    u AS (SELECT *, CASE WHEN mean <> 0 THEN slope / mean ELSE 0 END AS relative FROM t)"""
TREND_CASE = """CASE WHEN n < 5 THEN 'insufficient_data' WHEN relative > 0.1 THEN 'increasing'
    WHEN relative < -0.1 THEN 'declining' ELSE 'stable' END"""


@query(
    "trend",
    f"""WITH {TREND_SQL.format(table='long_daily')}
        SELECT n AS rows, {num('slope', 'slope')}, {num('mean', 'mean')}, {num('relative', 'relative_slope')},
          {TREND_CASE} AS trend FROM u""",
    "long_daily",
)
def trend(spark, folder):
    return stats.trend(W.stored_daily(spark, folder))


DESCRIBED = [*V.METRICS, "temperature_mean", "precipitation_sum"]


@query(
    "describe_table",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT({name}) AS count, {num(f'AVG({name})', 'mean')}, "
        f"{num(f'STDDEV_SAMP({name})', 'std')}, {num(f'MIN({name})', 'min')}, "
        f"{num(f'QUANTILE_CONT({name}, 0.25)', 'q1')}, {num(f'QUANTILE_CONT({name}, 0.5)', 'median')}, "
        f"{num(f'QUANTILE_CONT({name}, 0.75)', 'q3')}, {num(f'MAX({name})', 'max')} FROM long_daily"
        for name in DESCRIBED
    ),
    "long_daily",
)
def describe_table(spark, folder):
    return stats.describe_table(W.long_daily(spark, folder))


RAW = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "metric_stats_raw",
    f"""WITH s AS ({stats_sql('lineitem', RAW)})
        SELECT metric, {nums('mean', 'std', 'q1', 'q3')}, {num('q3 - q1', 'iqr')}, {nums('min', 'max')}
        FROM s WHERE n >= 7""",
)
def metric_stats_raw(spark, folder):
    """Exact quartiles of raw records by refining bins; no buffer holds their values."""
    return stats.metric_stats(W.table(spark, folder, "lineitem"), RAW, by_bins=True)


@query(
    "describe_raw",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT({name}) AS count, {num(f'AVG({name})', 'mean')}, "
        f"{num(f'STDDEV_SAMP({name})', 'std')}, {num(f'MIN({name})', 'min')}, "
        f"{num(f'QUANTILE_CONT({name}, 0.25)', 'q1')}, {num(f'QUANTILE_CONT({name}, 0.5)', 'median')}, "
        f"{num(f'QUANTILE_CONT({name}, 0.75)', 'q3')}, {num(f'MAX({name})', 'max')} FROM equipment_sensors"
        for name in ["fuel_consumption"]
    ),
    "equipment_sensors",
)
def describe_raw(spark, folder):
    """Sensor readings, some of them missing."""
    return stats.describe_table(W.equipment_sensors(spark, folder), ["fuel_consumption"], by_bins=True)


CORRELATED = [*V.BASE_FEATURES, V.TARGET]


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, {num(f'CORR({a}, {b})', 'correlation')} FROM long_daily"
        for a in CORRELATED
        for b in CORRELATED
    ),
    "long_daily",
)
def correlation_matrix(spark, folder):
    return stats.correlation_matrix(W.long_daily(spark, folder))


@query(
    "correlation_by_moments",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, {num(f'CORR({a}, {b})', 'correlation')} FROM lineitem"
        for a in RAW
        for b in RAW
    ),
)
def correlation_by_moments(spark, folder):
    """On raw records, from products of matrices."""
    return moments.correlation_rows(W.table(spark, folder, "lineitem"), RAW)


def histogram_sql(table: str, name: str, bins: int) -> str:
    return f"""SELECT '{name}' AS column_name, CAST(b AS BIGINT) AS bin,
          {num(f'lo + (hi - lo) / {bins} * b', 'bin_start')}, {num(f'lo + (hi - lo) / {bins} * (b + 1)', 'bin_end')},
          (SELECT COUNT(*) FROM {table} WHERE {name} IS NOT NULL
             AND LEAST(CAST(FLOOR(({name} - lo) * CAST({bins} AS DOUBLE) / (hi - lo)) AS BIGINT), {bins - 1}) = b) AS count
        FROM (SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}) s, RANGE({bins}) r(b)"""


@query("histogram", histogram_sql("long_daily", V.TARGET, V.TARGET_BINS), "long_daily")
def histogram(spark, folder):
    return stats.histogram(W.stored_daily(spark, folder), V.TARGET, V.TARGET_BINS)


@query(
    "histogram_raw",
    histogram_sql("lineitem", "l_extendedprice", V.FEATURE_BINS),
)
def histogram_raw(spark, folder):
    """The same on raw records: one pass for the bounds, one for the counts."""
    return stats.histogram(W.table(spark, folder, "lineitem"), "l_extendedprice", V.FEATURE_BINS)


@query(
    "monthly_mean",
    f"""WITH f AS (SELECT * FROM long_daily),
        m AS (SELECT DATE_TRUNC('month', date) AS month, AVG(total_production_daily) AS mean_value FROM f GROUP BY 1),
        c AS (SELECT UNNEST(GENERATE_SERIES(MIN(DATE_TRUNC('month', date)), MAX(DATE_TRUNC('month', date)),
                INTERVAL 1 MONTH)) AS month FROM f)
        SELECT LAST_DAY(CAST(c.month AS DATE)) AS month_end, {nums('mean_value')}
        FROM c LEFT JOIN m ON c.month = m.month""",
    "long_daily",
)
def monthly_mean(spark, folder):
    return A.monthly_mean(W.stored_daily(spark, folder))


PREDICTED = """WITH p AS (SELECT l_returnflag AS model, CASE WHEN l_linestatus = 'F' THEN 'train' ELSE 'test' END AS split,
      l_extendedprice AS y, l_quantity * CAST(1500 AS DOUBLE) AS p FROM lineitem),
    a AS (SELECT model, split, AVG(y) AS mean FROM p GROUP BY 1, 2),
    e AS (SELECT p.model, p.split, AVG((y - p) ** 2) AS mse, SQRT(AVG((y - p) ** 2)) AS rmse, AVG(ABS(y - p)) AS mae,
            1 - SUM((y - p) ** 2) / SUM((y - mean) ** 2) AS r2,
            100 * AVG(ABS(y - p) / GREATEST(ABS(y), 2.220446049250313e-16)) AS mape
          FROM p JOIN a ON p.model = a.model AND p.split = a.split GROUP BY p.model, p.split)"""


def line_predictions(spark, folder):
    """Price per line against a price guessed from the quantity."""
    return W.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.when(F.col("l_linestatus") == "F", "train").otherwise("test").alias("split"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500.0).alias("prediction"),
    )


@query(
    "error_metrics",
    f"""{PREDICTED} SELECT model, split, {num('mse / 1000000', 'mse')}, {nums('rmse', 'mae', 'r2', 'mape')} FROM e""",
)
def error_metrics(spark, folder):
    return stats.error_metrics(line_predictions(spark, folder), ["model", "split"]).withColumn("mse", F.col("mse") / 1e6)


@query(
    "quality_score",
    f"""WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE tons_extracted < 0 OR tons_extracted > 1000)
            AS a, COUNT(*) FILTER (WHERE quality_grade < 0 OR quality_grade > 10) AS b FROM production_logs),
        d AS (SELECT SUM(k - 1) AS dup FROM (SELECT COUNT(*) AS k FROM production_logs GROUP BY date, mine_id, shift) g)
        SELECT {num('''100 - LEAST((a + b) / n * 100.0 * 0.8, 30) - LEAST(dup / n * 100.0 * 0.3, 15)
          - LEAST(5 * (CASE WHEN a > 0 THEN 1 ELSE 0 END + CASE WHEN b > 0 THEN 1 ELSE 0 END), 25)''', 'quality_score')}
        FROM c, d""",
    "production_logs",
)
def quality_score(spark, folder):
    return quality.table_quality(W.production_logs(spark, folder), "production_logs").select("quality_score")
