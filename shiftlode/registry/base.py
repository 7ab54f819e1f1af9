"""Registration, result shaping and the SQL text of the views."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHIFT, FINE_SHIFT = 3e-9, 3e-13


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query; ``views`` names the SQL views its oracle reads."""

    def keep(run):
        QUERIES[name] = lambda spark, folder: tidy(run(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql)
        return run

    return keep


def tidy(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, other numbers as DOUBLE with six decimals (ten below 1), lists as text.

    Sums of doubles differ in the last bits with the order of their parts. Both sides
    shift the value a little before rounding, so that a mean such as 0.0000125
    does not lie exactly between two results.
    """

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.NumericType):
            value = value.cast("double")
            fine = F.round(value + F.lit(FINE_SHIFT), 10)
            value = F.when(F.abs(value) < 1, fine).otherwise(F.round(value + F.lit(SHIFT), 6)) + F.lit(0.0)
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema])


def num(expression: str, name: str) -> str:
    """SQL for a number with six decimals, ten below 1; adding zero turns -0.0 into 0.0."""
    value = f"CAST({expression} AS DOUBLE)"
    return (
        f"CASE WHEN ABS({value}) < 1 THEN ROUND({value} + {FINE_SHIFT}, 10) ELSE ROUND({value} + {SHIFT}, 6) END "
        f"+ CAST(0 AS DOUBLE) AS {name}"
    )


def nums(*names: str) -> str:
    return ", ".join(num(name, name) for name in names)


def ints(*names: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in names)


# Views in SQL. A view may read the ones above it.
IMPACT = """LEAST(GREATEST(100.0 - (CASE WHEN precipitation_sum > 5 THEN (precipitation_sum - 5) * 2 ELSE 0 END)
    - ABS(temperature_mean - 25) * 1.5, 0.0), 100.0)"""

VIEWS = {
    "all_mines": """
        SELECT CAST(s_suppkey AS INTEGER) AS mine_id, 'MINE' || CAST(s_suppkey AS VARCHAR) AS mine_code,
               s_name AS mine_name, CAST(s_nationkey AS VARCHAR) AS location,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Maintenance' ELSE 'Active' END AS operational_status
        FROM supplier""",
    "mines": "SELECT * FROM all_mines WHERE mine_id % 10 <> 0",
    "production_logs": """
        SELECT DATE '2023-12-29' + CAST(l_orderkey % 40 AS INTEGER) AS date, CAST(l_suppkey AS INTEGER) AS mine_id,
               CASE WHEN l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS shift,
               l_quantity - CAST(3 AS DOUBLE) AS tons_extracted,
               l_discount * CAST(120 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS quality_grade,
               l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "equipment_sensors": """
        SELECT ts AS timestamp, 'EQ' || CAST(user_id % 10 AS VARCHAR) AS equipment_id,
               CASE event_type WHEN 'view' THEN 'active' WHEN 'click' THEN 'idle'
                    WHEN 'error' THEN 'maintenance' ELSE event_type END AS status,
               CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS fuel_consumption,
               event_type = 'error' AS maintenance_alert, event_id
        FROM events""",
    "weather_data": """
        SELECT DATE '2023-12-29' + CAST(o_orderkey % 35 AS INTEGER) AS date,
               CAST(2.0167 AS DOUBLE) AS latitude, CAST(117.3 AS DOUBLE) AS longitude,
               CAST(20 AS DOUBLE) + CAST(SUM(o_custkey) % 140 AS DOUBLE) / CAST(10 AS DOUBLE) AS temperature_mean,
               CAST(SUM(o_orderkey * o_custkey) % 13 AS DOUBLE) AS precipitation_sum,
               'Asia/Jakarta' AS timezone
        FROM orders GROUP BY 1""",
    "daily_series": """
        SELECT CAST(o_orderdate AS DATE) AS date, SUM(o_totalprice) / CAST(1000 AS DOUBLE) AS total_production_daily,
               AVG(CAST(o_custkey % 11 AS DOUBLE)) AS average_quality_grade
        FROM orders GROUP BY 1""",
    "long_parts": """
        SELECT CAST(o_orderdate AS DATE) AS date, SUM(o_totalprice) / CAST(1000 AS DOUBLE) AS total_production_daily,
               AVG(CAST(o_custkey % 11 AS DOUBLE)) AS average_quality_grade,
               AVG(CASE WHEN o_orderstatus = 'O' THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
                 AS equipment_utilization,
               CASE WHEN COUNT(*) % 10 <> 0 THEN AVG(CAST(o_custkey % 50 AS DOUBLE)) END AS fuel,
               CAST(20 AS DOUBLE) + CAST(SUM(o_custkey) % 140 AS DOUBLE) / CAST(10 AS DOUBLE) AS temperature_mean,
               CAST(SUM(o_orderkey * o_custkey) % 13 AS DOUBLE) AS precipitation_sum
        FROM orders GROUP BY 1""",
    "long_daily": f"""
        SELECT date, total_production_daily, average_quality_grade, equipment_utilization,
               CASE WHEN total_production_daily > 0 THEN fuel / total_production_daily ELSE 0 END AS fuel_efficiency,
               {IMPACT} AS weather_impact_score, temperature_mean, precipitation_sum
        FROM long_parts""",
    "clean_logs": """
        SELECT date, mine_id, shift, CASE WHEN tons_extracted < 0 THEN 0 ELSE tons_extracted END AS tons_extracted,
               CASE WHEN quality_grade < 0 THEN 0 WHEN quality_grade > 10 THEN 10 ELSE quality_grade END
                 AS quality_grade
        FROM production_logs""",
    "production_days": """
        SELECT date, COALESCE(SUM(tons_extracted), 0) AS total_production_daily,
               AVG(quality_grade) AS average_quality_grade
        FROM clean_logs GROUP BY date""",
    "equipment_daily": """
        SELECT CAST(timestamp AS DATE) AS date, equipment_id,
               AVG(CASE WHEN status = 'active' THEN 1.0 ELSE 0.0 END) * 100 AS utilization,
               AVG(fuel_consumption) AS fuel_consumption
        FROM equipment_sensors GROUP BY 1, 2""",
    "equipment_days": """
        SELECT date, AVG(utilization) AS equipment_utilization, AVG(fuel_consumption) AS avg_fuel_consumption
        FROM equipment_daily GROUP BY date""",
    "joined_days": f"""
        SELECT p.date, total_production_daily, average_quality_grade, equipment_utilization, avg_fuel_consumption,
               CASE WHEN total_production_daily > 0 THEN avg_fuel_consumption / total_production_daily ELSE 0 END
                 AS fuel_efficiency,
               CASE WHEN temperature_mean IS NOT NULL THEN {IMPACT} END AS weather_impact_score,
               temperature_mean, precipitation_sum
        FROM production_days p LEFT JOIN equipment_days e ON p.date = e.date
             LEFT JOIN weather_data w ON p.date = w.date""",
    "cleaning_counts": """
        SELECT COUNT(*) FILTER (WHERE tons_extracted < 0) AS negative_tons,
               COUNT(*) FILTER (WHERE quality_grade < 0 OR quality_grade > 10) AS invalid_grades
        FROM production_logs""",
    "cleaning_flags": """
        SELECT CONCAT_WS(',',
                 CASE WHEN negative_tons > 0 THEN 'negative_tons_extracted_' || negative_tons END,
                 CASE WHEN invalid_grades > 0 THEN 'invalid_quality_grade_' || invalid_grades END) AS anomaly_flags
        FROM cleaning_counts""",
    "transformed": """
        SELECT date, total_production_daily, average_quality_grade,
               COALESCE(LAST_VALUE(equipment_utilization IGNORE NULLS) OVER w, 50.0) AS equipment_utilization,
               COALESCE(LAST_VALUE(avg_fuel_consumption IGNORE NULLS) OVER w, 5.0) AS avg_fuel_consumption,
               fuel_efficiency, weather_impact_score,
               COALESCE(temperature_mean, 26.0) AS temperature_mean,
               COALESCE(precipitation_sum, 0.0) AS precipitation_sum
        FROM joined_days
        WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "daily_metrics": """
        SELECT date, total_production_daily, average_quality_grade, equipment_utilization, fuel_efficiency,
               weather_impact_score, temperature_mean, precipitation_sum FROM transformed""",
    "daily_production_metrics": "SELECT * FROM daily_metrics",
}

# The views each view reads.
_NEEDS = {
    "mines": ["all_mines"],
    "long_daily": ["long_parts"],
    "clean_logs": ["production_logs"],
    "production_days": ["clean_logs"],
    "equipment_daily": ["equipment_sensors"],
    "equipment_days": ["equipment_daily"],
    "joined_days": ["production_days", "equipment_days", "weather_data"],
    "cleaning_counts": ["production_logs"],
    "cleaning_flags": ["cleaning_counts"],
    "transformed": ["joined_days"],
    "daily_metrics": ["transformed"],
    "daily_production_metrics": ["daily_metrics"],
}


def with_views(names: list[str], sql: str) -> str:
    """Put the views before the statement; a statement that starts with WITH goes on."""
    needed, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(_NEEDS.get(name, []))
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
