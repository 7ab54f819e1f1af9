"""Sources and sinks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import schemas
from shiftlode.operators import aggregates as A
from shiftlode.operators import joins as J
from shiftlode.plans import daily as D
from shiftlode.registry.base import ints, num, nums, query
from shiftlode.session import new_path
from shiftlode.sinks import tables as K
from shiftlode.sources import dump, files
from shiftlode.sources import views as W

LOG_COLUMNS = ["date", "mine_id", "shift", "tons_extracted", "quality_grade"]


def typed_logs(spark, folder) -> DataFrame:
    """Shift records with the declared decimals, as they stand in a dump."""
    logs = W.production_logs(spark, folder)
    return logs.withColumns(
        {
            "tons_extracted": F.col("tons_extracted").cast("decimal(10,2)"),
            "quality_grade": F.round("quality_grade", 1).cast("decimal(3,1)"),
        }
    )


def fixture_daily(spark, folder) -> DataFrame:
    return D.daily_metrics(
        W.production_logs(spark, folder), W.equipment_sensors(spark, folder), W.weather_data(spark, folder)
    )


@query(
    "scan_insert_dump",
    f"SELECT date, {ints('mine_id')}, shift, {nums('tons_extracted', 'quality_grade')} FROM production_logs",
    "production_logs",
)
def scan_insert_dump(spark, folder):
    """The shift records are written as a dump with every kind of statement and read back."""
    path = new_path(spark, "dump")
    dump_text(typed_logs(spark, folder), "production_logs").write.text(path)
    return dump.read_production_logs(spark, path)


def dump_text(df: DataFrame, table: str) -> DataFrame:
    """Statements of a table: two on a line, over several lines, with comments, with several rows."""
    line = dump.insert_lines(df, table).select("value", F.pmod(F.xxhash64("value"), F.lit(5)).alias("kind"))
    value, kind = F.col("value"), F.col("kind")
    again = F.regexp_replace(value, r"^.*?VALUES (.*);$", ", $1;")
    other = F.lit(f" INSERT INTO other_{table} (text) VALUES ('a; b (c)'); ")
    return line.select(
        F.when(kind == 0, F.concat(other, value))
        .when(kind == 1, F.concat(value, F.lit(" -- it's a record; INSERT INTO")))
        .when(kind == 2, F.regexp_replace(value, " VALUES ", "\n  VALUES\n  "))
        .when(kind == 3, F.concat(F.lit("/* ; ( ' */ "), value, other))
        .otherwise(value)
        .alias("value")
    ).withColumn("value", F.coalesce("value", again))


@query(
    "dump_several_rows",
    f"SELECT date, {ints('mine_id')}, shift, {nums('tons_extracted', 'quality_grade')} FROM production_logs",
    "production_logs",
)
def dump_several_rows(spark, folder):
    """All records of a day and mine as one statement with several rows."""
    path = new_path(spark, "dump")
    rows = F.regexp_extract(F.col("value"), r"VALUES (.*);$", 1)
    logs = typed_logs(spark, folder)
    lines = dump.insert_lines(logs, "production_logs").select(rows.alias("row"))
    grouped = lines.groupBy(F.pmod(F.xxhash64("row"), F.lit(997)).alias("part")).agg(F.collect_list("row").alias("rows"))
    head = f"INSERT INTO production_logs ({', '.join(logs.columns)}) VALUES\n"
    grouped.select(F.concat(F.lit(head), F.array_join("rows", ",\n"), F.lit(";")).alias("value")).write.text(path)
    return dump.read_production_logs(spark, path)


@query(
    "dump_rejects",
    """SELECT 'production_logs' AS table_name, CAST(mine_id % 3 AS BIGINT) AS kind, COUNT(*) AS records
       FROM production_logs WHERE mine_id % 7 = 0 GROUP BY mine_id % 3""",
    "production_logs",
)
def dump_rejects(spark, folder):
    """Every record of the mines 0, 7, 14, ... is broken: no date, a value too few, or a text for tons."""
    path = new_path(spark, "dump")
    logs = typed_logs(spark, folder)
    lines = dump.insert_lines(logs.select("*", F.col("mine_id").alias("hurt")), "production_logs")
    value, hurt = F.regexp_replace("value", ", hurt\\)", ")"), F.regexp_extract("value", r", (\d+)\);$", 1).cast("int")
    value = F.regexp_replace(value, r", \d+\);$", ");")
    broken = (
        F.when(hurt % 3 == 0, F.regexp_replace(value, r"\('\d{4}", "('day"))
        .when(hurt % 3 == 1, F.regexp_replace(value, r", [^,]*\);$", ");"))
        .otherwise(F.regexp_replace(value, r"('(?:Day|Night)', )[^,]*", "$1'many'"))
    )
    lines.select(F.when(hurt % 7 == 0, broken).otherwise(value).alias("value")).write.text(path)
    found = dump.rejects(dump.production_records(spark, path), "production_logs")
    kind = F.when(F.col("record").contains("'day"), 0).when(F.col("record").contains("'many'"), 2).otherwise(1)
    return found.groupBy("table_name", kind.alias("kind")).agg(F.count("*").alias("records"))


@query(
    "scan_insert_dump_mines",
    f"""SELECT {ints('mine_id')}, mine_code, mine_name, location || ', d''Or' AS location, operational_status
        FROM all_mines""",
    "all_mines",
)
def scan_insert_dump_mines(spark, folder):
    """Text with a comma and a quote has to come back whole."""
    path = new_path(spark, "dump")
    mines = W.all_mines(spark, folder).withColumn("location", F.concat("location", F.lit(", d'Or")))
    dump.insert_lines(mines, "mines").write.text(path)
    return dump.read_mines(spark, path)


CUT_TEXT = "; \n;\n/* it''s -- one;\ntext"  # holds the end of a statement twice, and signs of comments


@query(
    "dump_cut_texts",
    f"""SELECT {ints('mine_id')}, mine_code, mine_name, location || '{CUT_TEXT}' AS location, operational_status, CAST(0 AS BIGINT) AS rejected
        FROM all_mines""",
    "all_mines",
)
def dump_cut_texts(spark, folder):
    """Texts and comments with a semicolon at a line end, which are cut by the reader and put together again."""
    path = new_path(spark, "dump")
    mines = W.all_mines(spark, folder).withColumn("location", F.concat("location", F.lit(CUT_TEXT.replace("''", "'"))))
    comment = F.when(F.pmod(F.xxhash64("value"), F.lit(2)) == 0, "/* don't;\n read */ ").otherwise("-- it's;\n")
    dump.insert_lines(mines, "mines").select(F.concat(comment, "value").alias("value")).write.text(path)
    records = dump.mine_records(spark, path)
    return dump.accepted(records).withColumn("rejected", F.lit(dump.rejects(records, "mines").count()))


@query(
    "scan_sensor_csv",
    f"""SELECT STRFTIME(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, equipment_id, status,
        {nums('fuel_consumption')}, maintenance_alert FROM equipment_sensors""",
    "equipment_sensors",
)
def scan_sensor_csv(spark, folder):
    path = new_path(spark, "sensors-csv")
    sensors = W.equipment_sensors(spark, folder)
    sensors.withColumn("timestamp", F.col("timestamp").cast("string")).write.option("header", True).csv(path)
    return files.read_sensor_csv(spark, path)


WEATHER = f"date, {nums('latitude', 'longitude', 'temperature_mean', 'precipitation_sum')}, timezone"


@query("scan_weather_json", f"SELECT {WEATHER} FROM weather_data", "weather_data")
def scan_weather_json(spark, folder):
    path = new_path(spark, "payloads")
    files.payload_lines(W.weather_data(spark, folder)).write.text(path)
    return files.read_weather_payloads(spark, path)


@query(
    "weather_source_kind",
    """SELECT date, CASE WHEN date <= DATE '1998-08-02' THEN 'historical' ELSE 'forecast' END AS source_kind
       FROM daily_series""",
    "daily_series",
)
def weather_source_kind(spark, folder):
    return files.with_source_kind(W.daily_series(spark, folder).select("date"), "1998-08-02")


@query("scan_projected", f"SELECT date, {nums('temperature_mean', 'precipitation_sum')} FROM weather_data", "weather_data")
def scan_projected(spark, folder):
    return files.scan_columns(W.weather_data(spark, folder), "date", "temperature_mean", "precipitation_sum")


@query(
    "scan_date_filtered",
    f"""SELECT date, {ints('mine_id')}, shift, {nums('tons_extracted', 'quality_grade')}
        FROM production_logs WHERE date >= DATE '2024-01-10'""",
    "production_logs",
)
def scan_date_filtered(spark, folder):
    return files.scan_since(W.production_logs(spark, folder), "2024-01-10")


@query(
    "scan_date_filtered_sensors",
    f"""SELECT STRFTIME(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, equipment_id, status,
        {nums('fuel_consumption')}, maintenance_alert
        FROM equipment_sensors WHERE CAST(timestamp AS DATE) >= DATE '2024-01-15'""",
    "equipment_sensors",
)
def scan_date_filtered_sensors(spark, folder):
    return files.scan_since(W.equipment_sensors(spark, folder), "2024-01-15", "timestamp")


SOURCE_TABLES = ["mines", "production_logs", "equipment_sensors", "weather_data"]


def source_tables(spark, folder) -> dict[str, DataFrame]:
    tables = {name: getattr(W, name)(spark, folder) for name in SOURCE_TABLES}
    return {**tables, "mines": W.all_mines(spark, folder)}


_COLUMN_ROWS = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST({position} AS BIGINT) AS position, '{field.name}' AS column_name, "
    f"COUNT({field.name}) AS filled FROM {'all_mines' if table == 'mines' else table}"
    for table, schema in [
        ("mines", schemas.MINES),
        ("production_logs", schemas.PRODUCTION_LOGS),
        ("equipment_sensors", schemas.EQUIPMENT_SENSORS),
        ("weather_data", schemas.WEATHER_DATA),
    ]
    for position, field in enumerate(schema)
)


@query("table_columns", _COLUMN_ROWS, "all_mines production_logs equipment_sensors weather_data")
def table_columns(spark, folder):
    """Columns and positions of the source tables with the number of filled values."""
    tables = source_tables(spark, folder)
    counts = None
    for name, df in tables.items():
        wide = df.agg(*[F.count(column).alias(column) for column in df.columns])
        part = wide.select(F.lit(name).alias("table_name"), "*").unpivot(
            "table_name", df.columns, "column_name", "filled"
        )
        counts = part if counts is None else counts.unionByName(part)
    return files.columns_of(spark, tables).drop("data_type").join(counts, ["table_name", "column_name"])


@query(
    "calendar",
    """SELECT CAST(UNNEST(GENERATE_SERIES(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily_series""",
    "daily_series",
)
def calendar(spark, folder):
    return files.calendar(A.date_bounds(W.daily_series(spark, folder)))


@query(
    "weather_with_defaults",
    f"""WITH bounds AS (SELECT MIN(date) AS a, MAX(date) AS b FROM production_logs),
        days AS (SELECT CAST(UNNEST(GENERATE_SERIES(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
        SELECT days.date, {num('COALESCE(latitude, 2.0167)', 'latitude')},
          {num('COALESCE(longitude, 117.3)', 'longitude')},
          {num('COALESCE(temperature_mean, 26.0)', 'temperature_mean')},
          {num('COALESCE(precipitation_sum, 0.0)', 'precipitation_sum')},
          COALESCE(timezone, 'Asia/Jakarta') AS timezone
        FROM days LEFT JOIN weather_data w ON days.date = w.date""",
    "production_logs weather_data",
)
def weather_with_defaults(spark, folder):
    days = files.calendar(A.date_bounds(W.production_logs(spark, folder)))
    return files.weather_with_defaults(days, W.weather_data(spark, folder))


DAILY = f"""date, {nums('total_production_daily', 'average_quality_grade', 'equipment_utilization',
    'fuel_efficiency', 'weather_impact_score', 'temperature_mean', 'precipitation_sum')}"""


@query(
    "write_full_refresh",
    f"SELECT {DAILY}, anomaly_flags FROM daily_metrics, cleaning_flags",
    "daily_metrics cleaning_flags",
)
def write_full_refresh(spark, folder):
    """Stored twice: the second refresh replaces the first."""
    path = new_path(spark, "daily")
    daily = fixture_daily(spark, folder)
    K.full_refresh(daily, path)
    return K.full_refresh(daily, path)


@query(
    "append_quality_log",
    """SELECT 'production_logs' AS table_name, 'negative_tons_extracted' AS anomaly_type,
         'Found ' || negative_tons || ' records with negative tons_extracted, replaced with 0' AS description,
         CAST(negative_tons AS BIGINT) AS affected_records, 'WARNING' AS severity
       FROM cleaning_counts WHERE negative_tons > 0""",
    "cleaning_counts",
)
def append_quality_log(spark, folder):
    path = new_path(spark, "quality-log")
    K.append_quality_log(D.cleaning_issues(W.production_logs(spark, folder)), path)
    return spark.read.schema(schemas.DATA_QUALITY_LOG).parquet(path).drop("id", "timestamp")


SUMMARY = f"""SELECT MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS days,
    {num('SUM(total_production_daily)', 'total_production')}, {num('AVG(total_production_daily)', 'mean_production')},
    {', '.join(num(f'AVG({name})', f'mean_{name}') for name in (
        'average_quality_grade', 'equipment_utilization', 'fuel_efficiency', 'weather_impact_score'))}"""


@query("write_json_report", f"{SUMMARY} FROM long_daily", "long_daily")
def write_json_report(spark, folder):
    path = new_path(spark, "report")
    summary = A.run_summary(W.long_daily(spark, folder))
    K.write_json(summary, path)
    return K.read_json_report(spark, path, summary.schema)


@query(
    "refresh_order",
    """SELECT 'mines' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS orphans FROM mines
       UNION ALL
       SELECT 'production_logs', COUNT(*), COUNT(*) FILTER (WHERE mine_id NOT IN (SELECT mine_id FROM mines))
       FROM production_logs""",
    "mines production_logs",
)
def refresh_order(spark, folder):
    """Parents first, then children, then the check of the reference between them."""
    stored = K.refresh_tables(
        {name: (getattr(W, name)(spark, folder), new_path(spark, name)) for name in ("mines", "production_logs")}
    )
    mines, logs = stored["mines"], stored["production_logs"]
    orphans = J.orphan_keys(logs, mines, "mine_id").agg(F.coalesce(F.sum("orphans"), F.lit(0))).scalar()
    return mines.agg(F.count("*").alias("rows")).select(
        F.lit("mines").alias("table_name"), "rows", F.lit(0).alias("orphans")
    ).unionByName(
        logs.agg(F.count("*").alias("rows")).select(
            F.lit("production_logs").alias("table_name"), "rows", orphans.alias("orphans")
        )
    )


@query(
    "generated_columns",
    """SELECT COUNT(*) AS rows, CAST(1 AS BIGINT) AS first_id, COUNT(*) AS filled_ids, COUNT(*) AS distinct_ids,
         COUNT(*) AS stamped FROM production_logs""",
    "production_logs",
)
def generated_columns(spark, folder):
    """Stored ids of all shift records, each once, and a time of writing."""
    numbered = K.with_created_at(K.with_generated_id(W.production_logs(spark, folder), "log_id"))
    return K.full_refresh(numbered, new_path(spark, "numbered")).agg(
        F.count("*").alias("rows"),
        F.min("log_id").alias("first_id"),
        F.count("log_id").alias("filled_ids"),
        F.count_distinct("log_id").alias("distinct_ids"),
        F.count("created_at").alias("stamped"),
    )
