"""Projections, casts, filters and scalar functions."""

from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions import scalars as S
from shiftlode.operators import aggregates as A
from shiftlode.operators import filters
from shiftlode.plans import daily as D
from shiftlode.plans import features as X
from shiftlode.registry.base import ints, num, nums, query
from shiftlode.registry.scans import DAILY, fixture_daily, typed_logs
from shiftlode.sources import dump
from shiftlode.sources import views as W


@query("select_reorder", f"SELECT {DAILY}, anomaly_flags FROM daily_metrics, cleaning_flags", "daily_metrics cleaning_flags")
def select_reorder(spark, folder):
    return fixture_daily(spark, folder).select(*V.DAILY_COLUMNS)


@query(
    "rename",
    f"SELECT date, {nums('equipment_utilization', 'avg_fuel_consumption')} FROM equipment_days",
    "equipment_days",
)
def rename(spark, folder):
    per_equipment = A.equipment_daily(W.equipment_sensors(spark, folder))
    return per_equipment.groupBy("date").agg(
        F.avg("utilization").alias("equipment_utilization"),
        F.avg("fuel_consumption").alias("avg_fuel_consumption"),
    )


@query(
    "cast_types",
    f"""SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_text,
          {num("o_totalprice", "price")}, TRY_CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT) AS priority,
          TRY_CAST(o_orderstatus AS BIGINT) AS status_number FROM orders""",
)
def cast_types(spark, folder):
    """Text to numbers with ``try_cast``: text that is no number becomes NULL."""
    orders = W.table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        day.alias("order_date"),
        day.cast("string").alias("date_text"),
        F.col("o_totalprice").cast("string").try_cast("double").alias("price"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderstatus").try_cast("int").alias("status_number"),
    )


@query(
    "filter_last_n_days",
    f"""SELECT date, {nums('total_production_daily', 'average_quality_grade')} FROM daily_series
        WHERE date >= (SELECT MAX(date) FROM daily_series) - 30""",
    "daily_series",
)
def filter_last_n_days(spark, folder):
    return filters.last_n_days(W.stored_series(spark, folder))


@query(
    "filter_date_range",
    f"""SELECT date, {nums('total_production_daily', 'average_quality_grade')} FROM daily_series
        WHERE date >= DATE '1997-01-01' AND date <= DATE '1998-12-31'""",
    "daily_series",
)
def filter_date_range(spark, folder):
    return filters.date_range(W.daily_series(spark, folder), "1997-01-01", "1998-12-31")


@query(
    "drop_incomplete_rows",
    f"SELECT {DAILY} FROM long_daily WHERE fuel_efficiency IS NOT NULL",
    "long_daily",
)
def drop_incomplete_rows(spark, folder):
    return filters.complete_rows(W.long_daily(spark, folder))


@query(
    "string_tokens",
    """SELECT CONCAT_WS('|', CAST(date AS VARCHAR), CAST(mine_id AS VARCHAR), shift,
         CAST(CAST(tons_extracted AS DECIMAL(10,2)) AS VARCHAR),
         CAST(CAST(ROUND(quality_grade, 1) AS DECIMAL(3,1)) AS VARCHAR)) AS tokens FROM production_logs""",
    "production_logs",
)
def string_tokens(spark, folder):
    """The values of a statement, split on commas, without blanks and quotes."""
    lines = dump.insert_lines(typed_logs(spark, folder), "production_logs")
    statements = dump.insert_statements(lines, "production_logs")
    values = F.regexp_extract("statement", dump.ROW + r"\s*$", 1)
    return statements.select(F.array_join(S.tokens(values), "|").alias("tokens"))


KEY_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey"]
LOG_INTS = ints(*KEY_COLUMNS)


@query("clamp_negative", f"SELECT {LOG_INTS}, {num('GREATEST(tons_extracted, 0)', 'tons_extracted')} FROM production_logs", "production_logs")
def clamp_negative(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    return logs.select(*KEY_COLUMNS, S.clamp_negative(F.col("tons_extracted")).alias("tons_extracted"))


@query(
    "clamp_range",
    f"SELECT {LOG_INTS}, {num('LEAST(GREATEST(quality_grade, 0), 10)', 'quality_grade')} FROM production_logs",
    "production_logs",
)
def clamp_range(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    grade = S.clamp_range(F.col("quality_grade"), V.GRADE_MIN, V.GRADE_MAX)
    return logs.select(*KEY_COLUMNS, grade.alias("quality_grade"))


@query(
    "fuel_efficiency",
    f"""SELECT {ints('l_orderkey', 'l_linenumber', 'l_partkey')},
          {num("CASE WHEN tons_extracted > 0 THEN quality_grade / tons_extracted ELSE 0 END", "fuel_efficiency")}
        FROM production_logs""",
    "production_logs",
)
def fuel_efficiency(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    return logs.select(
        *KEY_COLUMNS, S.fuel_efficiency(F.col("quality_grade"), F.col("tons_extracted")).alias("fuel_efficiency")
    )


@query(
    "weather_impact_score",
    f"""SELECT p.date, {num('''CASE WHEN temperature_mean IS NOT NULL THEN LEAST(GREATEST(100 - 1.5 *
          ABS(temperature_mean - 25) - 2 * GREATEST(precipitation_sum - 5, 0), 0), 100) END''', 'weather_impact_score')}
        FROM production_days p LEFT JOIN weather_data w ON p.date = w.date""",
    "production_days weather_data",
)
def weather_impact_score(spark, folder):
    """Days without weather stay NULL."""
    days = W.production_logs(spark, folder).select("date").distinct()
    score = S.weather_impact_score(F.col("temperature_mean"), F.col("precipitation_sum"))
    return days.join(W.weather_data(spark, folder), "date", "left").select("date", score.alias("weather_impact_score"))


@query(
    "fill_constant",
    f"""SELECT p.date, {num('COALESCE(temperature_mean, 26.0)', 'temperature_mean')},
          {num('COALESCE(precipitation_sum, 0.0)', 'precipitation_sum')}
        FROM production_days p LEFT JOIN weather_data w ON p.date = w.date""",
    "production_days weather_data",
)
def fill_constant(spark, folder):
    days = W.production_logs(spark, folder).select("date").distinct()
    joined = days.join(W.weather_data(spark, folder), "date", "left")
    return joined.select("date", "temperature_mean", "precipitation_sum").fillna(
        {"temperature_mean": V.DEFAULT_TEMPERATURE, "precipitation_sum": V.DEFAULT_RAIN}
    )


@query(
    "date_parts",
    """SELECT date, CAST(YEAR(date) AS BIGINT) AS year, CAST(MONTH(date) AS BIGINT) AS month,
         CAST(DAY(date) AS BIGINT) AS day, CAST(DAYOFYEAR(date) AS BIGINT) AS day_of_year,
         CAST(WEEKOFYEAR(date) AS BIGINT) AS week_of_year, CAST(ISODOW(date) - 1 AS BIGINT) AS day_of_week,
         CAST(CASE WHEN ISODOW(date) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM daily_series""",
    "daily_series",
)
def date_parts(spark, folder):
    return X.with_date_parts(W.daily_series(spark, folder).select("date"))


@query(
    "interaction_features",
    f"""SELECT date, {num('average_quality_grade * equipment_utilization', 'quality_utilization')},
          {num('fuel_efficiency * weather_impact_score', 'efficiency_weather')} FROM long_daily""",
    "long_daily",
)
def interaction_features(spark, folder):
    return X.with_interactions(W.long_daily(spark, folder)).select("date", "quality_utilization", "efficiency_weather")


@query(
    "polynomial_features",
    f"""SELECT date, {num('equipment_utilization ** 2', 'equipment_utilization_squared')},
          {num('LN(1 + equipment_utilization)', 'equipment_utilization_log')},
          {num('average_quality_grade ** 2', 'average_quality_grade_squared')},
          {num('LN(1 + average_quality_grade)', 'average_quality_grade_log')} FROM long_daily""",
    "long_daily",
)
def polynomial_features(spark, folder):
    return X.with_polynomials(W.long_daily(spark, folder)).select("date", *S.polynomials())


@query(
    "temp_deviation",
    f"""SELECT date, {num('ABS(temperature_mean - (SELECT AVG(temperature_mean) FROM long_daily))', 'temp_deviation')}
        FROM long_daily""",
    "long_daily",
)
def temp_deviation(spark, folder):
    return X.with_temp_deviation(W.stored_daily(spark, folder)).select("date", "temp_deviation")


@query(
    "high_precipitation",
    """SELECT p.date, CAST(CASE WHEN precipitation_sum > 5 THEN 1 ELSE 0 END AS BIGINT) AS high_precipitation
       FROM production_days p LEFT JOIN weather_data w ON p.date = w.date""",
    "production_days weather_data",
)
def high_precipitation(spark, folder):
    days = W.production_logs(spark, folder).select("date").distinct()
    joined = days.join(W.weather_data(spark, folder), "date", "left")
    return X.with_high_precipitation(joined).select("date", "high_precipitation")


@query(
    "format_range",
    f"""SELECT {LOG_INTS},
          PRINTF('%.2f - %.2f', quality_grade / 7.0, tons_extracted / 8.0) AS range_text FROM production_logs""",
    "production_logs",
)
def format_range(spark, folder):
    """Two decimals, among them exact ties such as 0.125."""
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    return logs.select(
        *KEY_COLUMNS, S.range_text(F.col("quality_grade") / 7.0, F.col("tons_extracted") / 8.0).alias("range_text")
    )


@query(
    "date_diff_inclusive",
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key,
         CAST(CAST(l_shipdate AS DATE) - DATE '1995-01-01' + 1 AS BIGINT) AS days FROM lineitem""",
)
def date_diff_inclusive(spark, folder):
    days = S.days_inclusive(F.lit("1995-01-01").cast("date"), F.col("l_shipdate").cast("date"))
    return W.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        days.alias("days"),
    )


@query(
    "date_format",
    "SELECT STRFTIME(date, '%Y-%m-%d') AS date_text, COUNT(*) AS rows FROM production_logs GROUP BY 1",
    "production_logs",
)
def date_format(spark, folder):
    logs = W.production_logs(spark, folder)
    return logs.groupBy("date").agg(F.count("*").alias("rows")).select(S.date_text(F.col("date")).alias("date_text"), "rows")


@query("array_flags", "SELECT CAST(negative_tons AS BIGINT) AS negative_tons, CAST(invalid_grades AS BIGINT) AS invalid_grades, anomaly_flags FROM cleaning_counts, cleaning_flags", "cleaning_flags")
def array_flags(spark, folder):
    return D.cleaning_report(W.production_logs(spark, folder))


@query(
    "severity",
    f"""WITH s AS (SELECT AVG(total_production_daily) AS m, STDDEV_SAMP(total_production_daily) AS d FROM daily_series)
        SELECT date, CASE WHEN ABS(total_production_daily - m) > 3 * d THEN 'high' ELSE 'medium' END AS severity
        FROM daily_series, s""",
    "daily_series",
)
def severity(spark, folder):
    daily = W.stored_series(spark, folder)
    moments = daily.agg(F.struct(F.avg(V.TARGET).alias("mean"), F.stddev_samp(V.TARGET).alias("std"))).scalar()
    return daily.select("date", S.severity(F.col(V.TARGET), moments["mean"], moments["std"]).alias("severity"))


@query(
    "health_bucket",
    f"""SELECT {LOG_INTS}, CASE WHEN tons_extracted * 2 >= 95 THEN 'excellent' WHEN tons_extracted * 2 >= 85 THEN 'good'
          WHEN tons_extracted * 2 >= 70 THEN 'fair' ELSE 'poor' END AS health FROM production_logs""",
    "production_logs",
)
def health_bucket(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    return logs.select(*KEY_COLUMNS, S.health_bucket(F.col("tons_extracted") * 2).alias("health"))
