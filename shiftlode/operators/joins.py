"""Joins. All are left to Catalyst, which broadcasts a side when its size is under
``spark.sql.autoBroadcastJoinThreshold`` and splits the partitions of hot keys otherwise."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def join_production_equipment(production: DataFrame, equipment: DataFrame) -> DataFrame:
    return production.join(equipment, "date", "left")


def weather_of_days(weather: DataFrame) -> DataFrame:
    """One row per date: of several rows the one with the smallest temperature, then rain,
    with missing values last."""
    values = ("temperature_mean", "precipitation_sum")
    order = F.struct(*[x for name in values for x in (F.col(name).isNull(), F.col(name))])
    days = weather.where(F.col("date").isNotNull()).groupBy("date")
    return days.agg(F.min_by(F.struct(*values), order).alias("w")).select("date", "w.*")


def join_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of each day; repeated weather rows do not repeat the day."""
    return daily.join(weather_of_days(weather), "date", "left")


def missing_dates(calendar: DataFrame, present: DataFrame) -> DataFrame:
    """Days of the calendar without a row."""
    return calendar.join(present.select("date"), "date", "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys without a parent and how many child rows use them (counted before the join).
    A NULL key references nothing."""
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("orphans"))
    return used.join(parent.select(key), key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row; a NULL key references nothing.

    One anti join for all sizes: the parents are broadcast if their bytes allow it, and a
    hot key among the child rows is split by adaptive execution if not.
    """
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti").select(*child.columns)


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
