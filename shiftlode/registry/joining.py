"""Joins and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import aggregates as A
from shiftlode.operators import constraints as C
from shiftlode.operators import joins as J
from shiftlode.operators import quality, stats
from shiftlode.plans import daily as D
from shiftlode.registry.aggregation import stats_sql
from shiftlode.registry.base import ints, nums, query
from shiftlode.sources import files
from shiftlode.sources import views as W


def production_equipment(spark, folder):
    return J.join_production_equipment(
        A.daily_production(D.clean_production(W.production_logs(spark, folder))),
        D.equipment_days(W.equipment_sensors(spark, folder)),
    )


@query(
    "join_production_equipment",
    f"""SELECT p.date, {nums('total_production_daily', 'average_quality_grade', 'equipment_utilization',
          'avg_fuel_consumption')} FROM production_days p LEFT JOIN equipment_days e ON p.date = e.date""",
    "production_days equipment_days",
)
def join_production_equipment(spark, folder):
    return production_equipment(spark, folder)


@query(
    "join_weather",
    f"""SELECT p.date, {nums('total_production_daily', 'average_quality_grade', 'temperature_mean',
          'precipitation_sum')} FROM production_days p LEFT JOIN weather_data w ON p.date = w.date""",
    "production_days weather_data",
)
def join_weather(spark, folder):
    days = A.daily_production(D.clean_production(W.production_logs(spark, folder)))
    return J.join_weather(days, W.weather_data(spark, folder))


def outliers_sql(table: str) -> str:
    long = "\nUNION ALL ".join(f"SELECT date, '{name}' AS metric, {name} AS value FROM {table}" for name in V.METRICS)
    return f"""s AS (SELECT *, q3 - q1 AS iqr FROM ({stats_sql(table, V.METRICS)}) a),
        l AS ({long}),
        o AS (SELECT date, l.metric, value, mean, std, q1 - 1.5 * iqr AS lo, q3 + 1.5 * iqr AS hi
              FROM l JOIN s ON l.metric = s.metric WHERE n >= 7 AND (value < q1 - 1.5 * iqr OR value > q3 + 1.5 * iqr))"""


@query(
    "iqr_outliers",
    f"""WITH {outliers_sql('long_daily')}
        SELECT date, metric, {nums('value')}, PRINTF('%.2f - %.2f', lo, hi) AS expected_range,
          CASE WHEN ABS(value - mean) > 3 * std THEN 'high' ELSE 'medium' END AS severity FROM o""",
    "long_daily",
)
def iqr_outliers(spark, folder):
    return stats.iqr_outliers(W.stored_daily(spark, folder))


@query(
    "missing_dates",
    """WITH c AS (SELECT CAST(UNNEST(GENERATE_SERIES(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date
                  FROM production_logs)
       SELECT date FROM c WHERE date NOT IN (SELECT date FROM weather_data)""",
    "production_logs weather_data",
)
def missing_dates(spark, folder):
    days = files.calendar(A.date_bounds(W.production_logs(spark, folder)))
    return J.missing_dates(days, W.weather_data(spark, folder))


_GIVEN = {"date", "total_production_daily", "average_quality_grade"}
_MISSING = "\nUNION ALL ".join(
    f"SELECT 'daily_production_metrics' AS table_name, '{name}' AS missing_field, COUNT(*) AS total_records FROM daily_series"
    for name in V.RULES["daily_production_metrics"]["required"]
    if name not in _GIVEN
)


@query("missing_columns", _MISSING, "daily_series")
def missing_columns(spark, folder):
    """The daily series lacks three of the required columns of the daily table."""
    structure = quality.table_structure(W.daily_series(spark, folder), "daily_production_metrics")
    return structure.select("table_name", F.explode("missing_fields").alias("missing_field"), "total_records")


@query(
    "orphan_rows",
    f"""SELECT date, {ints('mine_id')}, shift, {nums('tons_extracted', 'quality_grade')} FROM production_logs
        WHERE mine_id NOT IN (SELECT mine_id FROM mines)""",
    "mines production_logs",
)
def orphan_rows(spark, folder):
    return J.orphan_rows(W.production_logs(spark, folder), W.mines(spark, folder), "mine_id")


@query(
    "orphan_keys",
    f"""SELECT {ints('mine_id')}, COUNT(*) AS orphans FROM production_logs
        WHERE mine_id NOT IN (SELECT mine_id FROM mines) GROUP BY production_logs.mine_id""",
    "mines production_logs",
)
def orphan_keys(spark, folder):
    return J.orphan_keys(W.production_logs(spark, folder), W.mines(spark, folder), "mine_id")


@query(
    "rejected_rows",
    """SELECT 'production_logs' AS table_name, 'orphan_mine_id' AS reason, COUNT(*) AS records FROM production_logs
       WHERE mine_id NOT IN (SELECT mine_id FROM mines)
       UNION ALL SELECT 'equipment_sensors', 'null_status', COUNT(*) FILTER (WHERE status IN ('purchase', 'signup')) FROM equipment_sensors
       UNION ALL SELECT 'weather_data', 'duplicate_date', COUNT(*) FILTER (WHERE precipitation_sum > 3) FROM weather_data""",
    "mines production_logs equipment_sensors weather_data",
)
def rejected_rows(spark, folder):
    """Records of unknown mines, readings whose status was taken away, weather days stored twice."""
    sensors = W.equipment_sensors(spark, folder)
    known = F.when(~F.col("status").isin("purchase", "signup"), F.col("status"))
    weather = W.weather_data(spark, folder)
    again = weather.where("precipitation_sum > 3").withColumn("temperature_mean", F.col("temperature_mean") + 1)
    checked = {
        "production_logs": (W.production_logs(spark, folder), {"mine_id": W.mines(spark, folder)}),
        "equipment_sensors": (sensors.withColumn("status", known), {}),
        "weather_data": (weather.unionByName(again), {}),
    }
    parts = []
    for name, (df, references) in checked.items():
        rules = C.Constraints(tuple(V.NOT_NULL[name]), tuple(V.UNIQUE.get(name, ())), references)
        parts.append(C.rejected_rows(C.with_reason(df, rules), name))
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy("table_name", "reason").agg(F.count("*").alias("records"))


@query(
    "unique_violations",
    f"""SELECT date, {ints('mine_id')}, shift, COUNT(*) AS rows FROM production_logs
        GROUP BY date, production_logs.mine_id, shift HAVING COUNT(*) > 1""",
    "production_logs",
)
def unique_violations(spark, folder):
    return J.unique_violations(W.production_logs(spark, folder), ["date", "mine_id", "shift"])


@query(
    "not_null_violations",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT(*) - COUNT({name}) AS violations FROM equipment_sensors"
        for name in ("timestamp", "equipment_id", "status", "fuel_consumption")
    ),
    "equipment_sensors",
)
def not_null_violations(spark, folder):
    columns = [*V.NOT_NULL["equipment_sensors"], "fuel_consumption"]
    return quality.not_null_violations(W.equipment_sensors(spark, folder), columns)


@query("attach_global_flags", "SELECT date, anomaly_flags FROM daily_metrics, cleaning_flags", "daily_metrics cleaning_flags")
def attach_global_flags(spark, folder):
    logs = W.production_logs(spark, folder)
    days = logs.select("date").distinct()
    return D.attach_flags(days, D.cleaning_report(logs).select("anomaly_flags"))
