"""Sensor CSV, landed weather payloads and stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlode import fixed_values as V
from shiftlode import schemas
from shiftlode.functions.scalars import as_double, source_kind

MONTH = "stored_month"


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV. Every column is read as text and cast with ``try_cast``, so one bad
    value becomes NULL in its own column and does not lose the record."""
    text = T.StructType([T.StructField(field.name, T.StringType()) for field in schemas.EQUIPMENT_SENSORS])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return parse_sensors(raw)


def parse_sensors(raw: DataFrame) -> DataFrame:
    """Type the text columns; booleans are parsed, so ``False`` and ``0`` are false."""
    return raw.select(
        F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        "equipment_id",
        "status",
        as_double(F.col("fuel_consumption").try_cast("double")).alias("fuel_consumption"),
        F.col("maintenance_alert").try_cast("boolean").alias("maintenance_alert"),
    )


def read_weather_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed service replies, one JSON object per line."""
    return parse_payloads(spark.read.text(path))


def parse_payloads(lines: DataFrame) -> DataFrame:
    """One row per day of every payload in the ``value`` column; empty replies give none.

    A day whose date cannot be read has a NULL date, which the load rejects and counts.
    """
    daily = F.arrays_zip(
        F.col("p.daily.time").alias("time"),
        F.col("p.daily.temperature_2m_mean").alias("temperature"),
        F.col("p.daily.precipitation_sum").alias("rain"),
    )
    days = lines.select(F.from_json("value", schemas.WEATHER_PAYLOAD).alias("p")).select(
        "p.latitude", "p.longitude", "p.timezone", F.explode(daily).alias("d")
    )
    return days.select(
        F.col("d.time").try_cast("date").alias("date"),
        "latitude",
        "longitude",
        as_double(F.col("d.temperature")).alias("temperature_mean"),
        as_double(F.col("d.rain")).alias("precipitation_sum"),
        "timezone",
    )


def payload_lines(weather: DataFrame) -> DataFrame:
    """The inverse: one payload per place and month (at most 31 days each)."""
    places = weather.groupBy("latitude", "longitude", "timezone", F.trunc("date", "MM").alias("month")).agg(
        F.array_sort(
            F.collect_list(F.struct("date", "temperature_mean", "precipitation_sum"))
        ).alias("days")
    )
    daily = F.struct(
        F.transform("days", lambda day: F.date_format(day["date"], "yyyy-MM-dd")).alias("time"),
        F.col("days.temperature_mean").alias("temperature_2m_mean"),
        F.col("days.precipitation_sum").alias("precipitation_sum"),
    )
    return places.select(
        F.to_json(F.struct("latitude", "longitude", "timezone", daily.alias("daily")), {"ignoreNullFields": "false"})
        .alias("value")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``min_date`` and ``max_date`` of a one-row table."""
    days = F.sequence(F.col("min_date"), F.col("max_date"), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("date"))


def calendar_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    span = spark.range(1).select(
        F.lit(start).cast("date").alias("min_date"), F.lit(end).cast("date").alias("max_date")
    )
    return calendar(span)


def weather_with_defaults(days: DataFrame, weather: DataFrame) -> DataFrame:
    """Every day of the calendar; a day without a weather row gets the site defaults.

    A row that is there keeps its own NULLs.
    """
    found = weather.withColumn("_found", F.lit(True))
    joined = days.select("date").join(found, "date", "left")

    def known(name, default):
        return F.when(F.col("_found"), F.col(name)).otherwise(F.lit(default)).alias(name)

    return joined.select(
        "date",
        known("latitude", V.SITE_LATITUDE),
        known("longitude", V.SITE_LONGITUDE),
        known("temperature_mean", V.DEFAULT_TEMPERATURE),
        known("precipitation_sum", V.DEFAULT_RAIN),
        known("timezone", V.SITE_TIMEZONE),
    )


def with_source_kind(days: DataFrame, as_of: str) -> DataFrame:
    return days.withColumn("source_kind", source_kind(F.col("date"), F.lit(as_of).cast("date")))


def scan_since(df: DataFrame, since: str | None, column: str = "date") -> DataFrame:
    """Rows from a day on. The column is compared as it is stored, so the filter reaches
    the file scan; midnight of the day is the same bound for a timestamp. Tables that are
    stored by month skip the folders before."""
    if since is None:
        return df
    kind = df.schema[column].dataType
    if MONTH in df.columns:
        df = df.where(F.col(MONTH) >= since[:7])
    return df.where(F.col(column) >= F.lit(since).cast(kind))


def with_month(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """The month as text, to store a table by."""
    return df.withColumn(MONTH, F.date_format(column, "yyyy-MM"))


def scan_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column names, positions and types of the tables, without reading a row."""
    rows = [
        (table, position, field.name, field.dataType.simpleString())
        for table, df in tables.items()
        for position, field in enumerate(df.schema)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")
