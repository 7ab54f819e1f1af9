"""From raw records to one row of metrics per day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions import scalars as S
from shiftlode.operators import aggregates as A
from shiftlode.operators import joins as J
from shiftlode.operators.ordered import forward_fill
from shiftlode.session import settle


def clean_production(logs: DataFrame) -> DataFrame:
    """Tons below zero become 0 and grades are held in 0..10; missing values stay."""
    return logs.withColumns(
        {
            "tons_extracted": S.clamp_negative(S.as_double(F.col("tons_extracted"))),
            "quality_grade": S.clamp_range(S.as_double(F.col("quality_grade")), V.GRADE_MIN, V.GRADE_MAX),
        }
    )


def _repairs():
    """How many records a cleaning touches, as aggregates over the raw records."""
    return (
        F.count_if(S.below(F.col("tons_extracted"), 0)).alias("negative_tons"),
        F.count_if(S.outside(F.col("quality_grade"), V.GRADE_MIN, V.GRADE_MAX)).alias("invalid_grades"),
    )


def _cleaning_flags(negative_tons, invalid_grades):
    return S.present(
        S.count_flag(V.FLAG_NEGATIVE_TONS, negative_tons),
        S.count_flag(V.FLAG_INVALID_GRADE, invalid_grades),
    )


def cleaning_report(logs: DataFrame) -> DataFrame:
    """One row: records repaired per kind and the resulting flags."""
    return logs.agg(*_repairs()).withColumn(
        "anomaly_flags", _cleaning_flags(F.col("negative_tons"), F.col("invalid_grades"))
    )


def cleaning_issues(logs: DataFrame) -> DataFrame:
    """Rows for the quality log: negative tons only, and none when there are none."""
    return _issues(cleaning_report(logs))


def _issues(counts: DataFrame) -> DataFrame:
    count = F.col("negative_tons").cast("string")
    return counts.where(F.col("negative_tons") > 0).select(
        F.lit("production_logs").alias("table_name"),
        F.lit(V.FLAG_NEGATIVE_TONS).alias("anomaly_type"),
        F.concat(F.lit(V.ISSUE_BEFORE), count, F.lit(V.ISSUE_AFTER)).alias("description"),
        F.col("negative_tons").cast("int").alias("affected_records"),
        F.lit(V.ISSUE_SEVERITY).alias("severity"),
    )


def production_days(logs: DataFrame) -> DataFrame:
    """Cleaned daily production with the repair counts of the day, in one pass."""
    marked = logs.withColumns(
        {
            "_negative": S.below(F.col("tons_extracted"), 0),
            "_invalid": S.outside(F.col("quality_grade"), V.GRADE_MIN, V.GRADE_MAX),
        }
    )
    return A.daily_production(
        clean_production(marked),
        F.count_if("_negative").alias("_negative"),
        F.count_if("_invalid").alias("_invalid"),
    )


def equipment_days(sensors: DataFrame) -> DataFrame:
    return A.equipment_metrics(A.equipment_daily(sensors))


def attach_flags(daily: DataFrame, flags: DataFrame, name: str = "anomaly_flags") -> DataFrame:
    """Put the one-row array ``flags`` on every row, after the flags already there."""
    new = flags.scalar()
    return daily.withColumn(name, F.concat(F.col(name), new) if name in daily.columns else new)


def transform(logs: DataFrame, sensors: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily metrics before validation, with the filled mean fuel.

    Efficiency and impact score are taken before the fills, so they stay NULL on days
    without sensors or weather. The joined days are written once: the fill, the flags
    and the caller then read that small table instead of the raw records. So the raw
    tables are read when this is called, not when its result is used.
    """
    return _filled(_joined_days(logs, sensors, weather))


def _joined_days(logs: DataFrame, sensors: DataFrame, weather: DataFrame) -> DataFrame:
    joined = J.join_weather(J.join_production_equipment(production_days(logs), equipment_days(sensors)), weather)
    return settle(
        joined.withColumns(
            {
                "fuel_efficiency": S.fuel_efficiency(F.col("avg_fuel_consumption"), F.col(V.TARGET)),
                "weather_impact_score": S.weather_impact_score(
                    F.col("temperature_mean"), F.col("precipitation_sum")
                ),
            }
        ),
        "days",
    )


def _filled(days: DataFrame) -> DataFrame:
    flags = days.agg(_cleaning_flags(F.sum("_negative"), F.sum("_invalid")))
    filled = forward_fill(
        days, {"equipment_utilization": V.DEFAULT_UTILIZATION, "avg_fuel_consumption": V.DEFAULT_FUEL}
    ).fillna({"temperature_mean": V.DEFAULT_TEMPERATURE, "precipitation_sum": V.DEFAULT_RAIN})
    return attach_flags(filled.drop("_negative", "_invalid"), flags)


def metric_checks(daily: DataFrame) -> DataFrame:
    """One row: days with a negative total, utilization outside 0..100, missing weather."""
    no_weather = F.col("temperature_mean").isNull() | F.col("precipitation_sum").isNull()
    counts = daily.agg(
        F.count_if(S.below(F.col(V.TARGET), 0)).alias("negative_total"),
        F.count_if(S.outside(F.col("equipment_utilization"), 0, 100)).alias("invalid_utilization"),
        F.count_if(no_weather).alias("missing_weather"),
    )
    return counts.withColumn(
        "errors",
        S.present(
            S.count_flag(V.FLAG_NEGATIVE_TOTAL, F.col("negative_total")),
            S.count_flag(V.FLAG_INVALID_UTILIZATION, F.col("invalid_utilization")),
            S.count_flag(V.FLAG_MISSING_WEATHER, F.col("missing_weather")),
        ),
    )


def validate_metrics(daily: DataFrame) -> DataFrame:
    """Append the texts of failed checks to the flags of every day."""
    return attach_flags(daily, metric_checks(daily).select("errors"))


def daily_metrics(logs: DataFrame, sensors: DataFrame, weather: DataFrame) -> DataFrame:
    """The stored daily table: transform, validate, keep the nine columns."""
    return daily_with_issues(logs, sensors, weather)[0]


def daily_with_issues(logs: DataFrame, sensors: DataFrame, weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The daily table and the rows for the quality log, from one pass over the raw records."""
    days = _joined_days(logs, sensors, weather)
    issues = _issues(days.agg(F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_tons")))
    return validate_metrics(_filled(days)).select(*V.DAILY_COLUMNS), issues
