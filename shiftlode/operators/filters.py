"""Row filters, column choice, sorting and limits."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V


def latest_date(df: DataFrame, column: str = "date") -> Column:
    """The newest date of the table, as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def last_n_days(df: DataFrame, days: int = V.RECENT_DAYS, as_of: str | Column | None = None) -> DataFrame:
    """Rows from ``days`` before ``as_of`` on; ``as_of`` defaults to the newest date."""
    if as_of is None:
        as_of = latest_date(df)
    elif isinstance(as_of, str):
        as_of = F.lit(as_of).cast("date")
    return df.where(F.col("date") >= F.date_sub(as_of, days))


def date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.dropna("any")


def daily_summary(daily: DataFrame) -> DataFrame:
    """Four columns, newest day first."""
    return daily.select(
        "date", "total_production_daily", "equipment_utilization", "weather_impact_score"
    ).orderBy(F.desc("date"))


def first_n(df: DataFrame, n: int = 10, order: str = "date") -> DataFrame:
    return df.orderBy(order).limit(n)
