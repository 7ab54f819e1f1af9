"""Table schemas. Nothing is inferred from files.

Timestamps carry no zone in the warehouse, so they are ``TIMESTAMP_NTZ`` here and no
result depends on the session time zone.
"""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MINES = _schema(
    ("mine_id", T.IntegerType()),
    ("mine_code", T.StringType()),
    ("mine_name", T.StringType()),
    ("location", T.StringType()),
    ("operational_status", T.StringType()),
)

PRODUCTION_LOGS = _schema(
    ("date", T.DateType()),
    ("mine_id", T.IntegerType()),
    ("shift", T.StringType()),
    ("tons_extracted", T.DecimalType(10, 2)),
    ("quality_grade", T.DecimalType(3, 1)),
)

EQUIPMENT_SENSORS = _schema(
    ("timestamp", T.TimestampNTZType()),
    ("equipment_id", T.StringType()),
    ("status", T.StringType()),
    ("fuel_consumption", T.DoubleType()),
    ("maintenance_alert", T.BooleanType()),
)

WEATHER_DATA = _schema(
    ("date", T.DateType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("temperature_mean", T.DoubleType()),
    ("precipitation_sum", T.DoubleType()),
    ("timezone", T.StringType()),
)

DAILY_PRODUCTION_METRICS = _schema(
    ("date", T.DateType()),
    ("total_production_daily", T.DoubleType()),
    ("average_quality_grade", T.DoubleType()),
    ("equipment_utilization", T.DoubleType()),
    ("fuel_efficiency", T.DoubleType()),
    ("weather_impact_score", T.DoubleType()),
    ("temperature_mean", T.DoubleType()),
    ("precipitation_sum", T.DoubleType()),
    ("anomaly_flags", T.ArrayType(T.StringType())),
)

DATA_QUALITY_LOG = _schema(
    ("id", T.LongType()),
    ("timestamp", T.TimestampNTZType()),
    ("table_name", T.StringType()),
    ("anomaly_type", T.StringType()),
    ("description", T.StringType()),
    ("affected_records", T.IntegerType()),
    ("severity", T.StringType()),
)

# One landed payload of the weather service: parallel arrays, one entry per day.
WEATHER_PAYLOAD = _schema(
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("timezone", T.StringType()),
    (
        "daily",
        _schema(
            ("time", T.ArrayType(T.StringType())),
            ("temperature_2m_mean", T.ArrayType(T.DoubleType())),
            ("precipitation_sum", T.ArrayType(T.DoubleType())),
        ),
    ),
)
