"""The warehouse tables derived from the TPC-H-like driver tables.

The driver tables have no mines, shifts or weather, so each warehouse table is a view
over one of them. Every view reads its whole table, but for ``mines``, which leaves out
every tenth mine so that there are records without a mine; ``all_mines`` has them all.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import as_double, fuel_efficiency, weather_impact_score
from shiftlode.session import settle

FIRST_DAY = "2023-12-29"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _day(key: str, days: int):
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col(key) % days).cast("int"))


def mines(spark: SparkSession, folder: str) -> DataFrame:
    return all_mines(spark, folder).where(F.col("mine_id") % 10 != 0)


def all_mines(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.cast("int").alias("mine_id"),
        F.concat(F.lit("MINE"), key.cast("string")).alias("mine_code"),
        F.col("s_name").alias("mine_name"),
        F.col("s_nationkey").cast("string").alias("location"),
        F.when(key % 3 == 0, "Maintenance").otherwise("Active").alias("operational_status"),
    )


def production_logs(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Shift records; ``extra`` names source columns to keep (as tie breakers)."""
    return table(spark, folder, "lineitem").select(
        _day("l_orderkey", 40).alias("date"),
        F.col("l_suppkey").cast("int").alias("mine_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "Day").otherwise("Night").alias("shift"),
        as_double(F.col("l_quantity") - 3.0).alias("tons_extracted"),
        as_double(F.col("l_discount") * 120.0 - 0.5).alias("quality_grade"),
        *extra,
    )


def equipment_sensors(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("EQ"), (F.col("user_id") % 10).cast("string")).alias("equipment_id"),
        F.when(kind == "view", "active").when(kind == "click", "idle")
        .when(kind == "error", "maintenance").otherwise(kind).alias("status"),
        as_double(F.when(F.col("event_id") % 50 != 0, F.col("value"))).alias("fuel_consumption"),
        (kind == "error").alias("maintenance_alert"),
        *extra,
    )


def _day_weather():
    """Made-up weather of a group of orders. Remainders are taken per row as well, so
    the sums cannot overflow."""
    warmth = F.sum(F.col("o_custkey") % 140) % 140
    rain = F.sum((F.col("o_orderkey") % 13) * (F.col("o_custkey") % 13)) % 13
    return (
        (F.lit(20.0) + warmth.cast("double") / 10.0).alias("temperature_mean"),
        rain.cast("double").alias("precipitation_sum"),
    )


def weather_data(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders").groupBy(_day("o_orderkey", 35).alias("date")).agg(*_day_weather())
    return days.select(
        "date",
        F.lit(V.SITE_LATITUDE).alias("latitude"),
        F.lit(V.SITE_LONGITUDE).alias("longitude"),
        "temperature_mean",
        "precipitation_sum",
        F.lit(V.SITE_TIMEZONE).alias("timezone"),
    )


def daily_series(spark: SparkSession, folder: str) -> DataFrame:
    """Long daily series (about 2,400 days) for windows, trend, features and models."""
    return table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        (F.sum("o_totalprice") / 1000.0).alias("total_production_daily"),
        F.avg((F.col("o_custkey") % 11).cast("double")).alias("average_quality_grade"),
    )


def long_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The daily series with all metrics. Fuel is unknown on some days, so rows are
    dropped from the features and the fills have something to do."""
    days = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        (F.sum("o_totalprice") / 1000.0).alias("total_production_daily"),
        F.avg((F.col("o_custkey") % 11).cast("double")).alias("average_quality_grade"),
        F.avg(F.when(F.col("o_orderstatus") == "O", 100.0).otherwise(0.0)).alias("equipment_utilization"),
        F.avg((F.col("o_custkey") % 50).cast("double")).alias("fuel"),
        F.count("*").alias("orders"),
        *_day_weather(),
    )
    fuel = F.when(F.col("orders") % 10 != 0, F.col("fuel"))
    return days.select(
        "date",
        "total_production_daily",
        "average_quality_grade",
        "equipment_utilization",
        fuel_efficiency(fuel, F.col("total_production_daily")).alias("fuel_efficiency"),
        weather_impact_score(F.col("temperature_mean"), F.col("precipitation_sum")).alias("weather_impact_score"),
        "temperature_mean",
        "precipitation_sum",
    )


def stored_daily(spark: SparkSession, folder: str) -> DataFrame:
    """``long_daily`` written once, for queries that read it several times."""
    return settle(long_daily(spark, folder), "long-daily")


def stored_series(spark: SparkSession, folder: str) -> DataFrame:
    return settle(daily_series(spark, folder), "daily-series")
