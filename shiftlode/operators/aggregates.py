"""Aggregations. All of them combine partial results before the shuffle, so a day or
key that holds a large share of the rows reaches the reducer as one row per task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import as_double


def daily_production(logs: DataFrame, *extra: Column) -> DataFrame:
    """Per date: total tons (0 when all are missing) and mean grade over the records.

    Records without a date belong to no day.
    """
    return logs.where(F.col("date").isNotNull()).groupBy("date").agg(
        F.coalesce(F.sum(as_double(F.col("tons_extracted"))), F.lit(0.0)).alias("total_production_daily"),
        F.avg(as_double(F.col("quality_grade"))).alias("average_quality_grade"),
        *extra,
    )


def equipment_daily(sensors: DataFrame) -> DataFrame:
    """Per date and equipment: share of active readings in percent, mean fuel.

    Readings without a time or an equipment belong to no group.
    """
    active = F.when(F.col("status") == V.ACTIVE_STATUS, 1.0).otherwise(0.0)
    known = sensors.where(F.col("timestamp").isNotNull() & F.col("equipment_id").isNotNull())
    return known.groupBy(F.to_date("timestamp").alias("date"), "equipment_id").agg(
        (F.avg(active) * 100).alias("utilization"),
        F.avg(as_double(F.col("fuel_consumption"))).alias("fuel_consumption"),
    )


def equipment_metrics(per_equipment: DataFrame) -> DataFrame:
    """Per date: mean over the equipment, each counting the same."""
    return per_equipment.groupBy("date").agg(
        F.avg("utilization").alias("equipment_utilization"),
        F.avg("fuel_consumption").alias("avg_fuel_consumption"),
    )


def weather_vs_production(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("precipitation_sum")
        .agg(F.avg("total_production_daily").alias("avg_production"))
        .orderBy("precipitation_sum")
    )


def status_distribution(sensors: DataFrame) -> DataFrame:
    return sensors.groupBy("status").agg(
        F.count("*").alias("readings"),
        F.avg(as_double(F.col("fuel_consumption"))).alias("avg_fuel"),
    )


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def date_bounds(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def run_summary(daily: DataFrame) -> DataFrame:
    """One row: the days covered, total and mean output, means of the other metrics."""
    others = [name for name in V.METRICS if name != V.TARGET]
    return daily.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("days"),
        F.coalesce(F.sum(V.TARGET), F.lit(0.0)).alias("total_production"),
        F.avg(V.TARGET).alias("mean_production"),
        *[F.avg(name).alias(f"mean_{name}") for name in others],
    )


def monthly_mean(daily: DataFrame, value: str = V.TARGET) -> DataFrame:
    """Mean per calendar month, labelled by its last day; months without rows are NULL."""
    month = F.trunc("date", "MM")
    means = daily.groupBy(month.alias("month")).agg(F.avg(value).alias("mean_value"))
    span = daily.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    months = span.select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    return months.join(means, "month", "left").select(F.last_day("month").alias("month_end"), "mean_value")
