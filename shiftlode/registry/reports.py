"""Composite checks and reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import quality, stats
from shiftlode.plans import check_states
from shiftlode.plans import daily as D
from shiftlode.plans import eda
from shiftlode.plans import features as X
from shiftlode.plans import validation as P
from shiftlode.registry.aggregation import TREND_CASE, TREND_SQL, histogram_sql, stats_sql
from shiftlode.registry.base import num, nums, query
from shiftlode.registry.columns import KEY_COLUMNS, LOG_INTS
from shiftlode.registry.joining import outliers_sql
from shiftlode.registry.ordering import CURRENT, EARLIER, LAG_SQL, WINDOW
from shiftlode.registry.scans import DAILY, fixture_daily
from shiftlode.session import new_path, settle
from shiftlode.sinks.tables import read_json_report, write_json
from shiftlode.sources import files
from shiftlode.sources import views as W

SINCE, UNTIL = "2024-01-01", "2024-02-06"


@query(
    "clean_production",
    f"""SELECT {LOG_INTS}, {num('GREATEST(tons_extracted, 0)', 'tons_extracted')},
          {num('LEAST(GREATEST(quality_grade, 0), 10)', 'quality_grade')}, anomaly_flags
        FROM production_logs, cleaning_flags""",
    "production_logs cleaning_flags",
)
def clean_production(spark, folder):
    logs = W.production_logs(spark, folder, *KEY_COLUMNS)
    clean = D.clean_production(logs).select(*KEY_COLUMNS, "tons_extracted", "quality_grade")
    return D.attach_flags(clean, D.cleaning_report(logs).select("anomaly_flags"))


@query("daily_metrics", f"SELECT {DAILY}, anomaly_flags FROM daily_metrics, cleaning_flags", "daily_metrics cleaning_flags")
def daily_metrics(spark, folder):
    return fixture_daily(spark, folder)


@query(
    "validate_metrics",
    """WITH c AS (SELECT COUNT(*) FILTER (WHERE total_production_daily < 0) AS a,
          COUNT(*) FILTER (WHERE equipment_utilization < 0 OR equipment_utilization > 100) AS b,
          COUNT(*) FILTER (WHERE temperature_mean IS NULL OR precipitation_sum IS NULL) AS d FROM joined_days)
       SELECT date, CONCAT_WS(',', anomaly_flags, CASE WHEN a > 0 THEN 'negative_total_production_' || a END,
          CASE WHEN b > 0 THEN 'invalid_equipment_utilization_' || b END,
          CASE WHEN d > 0 THEN 'missing_weather_data_' || d END) AS anomaly_flags
       FROM joined_days, cleaning_flags, c""",
    "joined_days cleaning_flags",
)
def validate_metrics(spark, folder):
    """On the days before the fills, where missing weather can be seen."""
    logs = W.production_logs(spark, folder)
    days = settle(
        D.J.join_weather(
            D.J.join_production_equipment(D.production_days(logs), D.equipment_days(W.equipment_sensors(spark, folder))),
            W.weather_data(spark, folder),
        ),
        "days",
    )
    flagged = D.attach_flags(days, D.cleaning_report(logs).select("anomaly_flags"))
    return D.validate_metrics(flagged).select("date", "anomaly_flags")


@query(
    "table_structure",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, TRUE AS structure_valid, '' AS missing_fields, COUNT(*) AS total_records FROM {name}"
        for name in V.RULES
    ),
    "production_logs equipment_sensors weather_data daily_production_metrics",
)
def table_structure(spark, folder):
    parts = [quality.table_structure(df, name) for name, df in checked_tables(spark, folder).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def checked_tables(spark, folder):
    return {
        "production_logs": W.production_logs(spark, folder),
        "equipment_sensors": W.equipment_sensors(spark, folder),
        "weather_data": W.weather_data(spark, folder),
        "daily_production_metrics": settle(fixture_daily(spark, folder).drop("anomaly_flags"), "daily"),
    }


CHECKED_COLUMNS = {
    "production_logs": ["date", "mine_id", "shift", "tons_extracted", "quality_grade"],
    "equipment_sensors": ["timestamp", "equipment_id", "status", "fuel_consumption", "maintenance_alert"],
    "weather_data": ["date", "latitude", "longitude", "temperature_mean", "precipitation_sum", "timezone"],
    "daily_production_metrics": [name for name in V.DAILY_COLUMNS if name != "anomaly_flags"],
}
QUALITY_COLUMNS = [
    "table_name", "records_checked", "null_total", "out_of_range_total", "duplicate_counts", "anomaly_kinds",
    "quality_score", "recommendations",
]


def quality_counts_sql(name: str, since: str | None) -> str:
    rule = V.RULES[name]
    columns = CHECKED_COLUMNS[name]
    day = "CAST(timestamp AS DATE)" if rule["date_column"] == "timestamp" else "date"
    where = f"WHERE {day} >= DATE '{since}'" if since else ""
    out = [
        f"COUNT(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
        for column, (low, high) in rule["ranges"].items()
    ]
    bad = [
        f"COUNT(*) FILTER (WHERE {column} IS NULL OR {column} NOT IN ({', '.join(repr(v) for v in values)}))"
        for column, values in rule["allowed"].items()
    ]
    kinds = " + ".join(f"CASE WHEN {count} > 0 THEN 1 ELSE 0 END" for count in out + bad)
    keys = ", ".join(rule["keys"])
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS n,
          {' + '.join(f'COUNT(*) - COUNT({column})' for column in columns)} AS nulls,
          {' + '.join(out)} AS outs, {kinds} AS kinds,
          (SELECT SUM(k - 1) FROM (SELECT COUNT(*) AS k FROM {name} {where} GROUP BY {keys}) g) AS dups
        FROM {name} {where}"""


def quality_sql(since: str | None) -> str:
    counts = "\nUNION ALL ".join(quality_counts_sql(name, since) for name in V.RULES)
    return f"""c AS ({counts}),
        q AS (SELECT *, GREATEST(0, 100 - LEAST(nulls / n * 100.0 * 0.5, 20) - LEAST(outs / n * 100.0 * 0.8, 30)
            - LEAST(dups / n * 100.0 * 0.3, 15) - LEAST(kinds * 5, 25)) AS score FROM c),
        checks AS (SELECT table_name, n AS records_checked, CAST(nulls AS BIGINT) AS null_total,
            CAST(outs AS BIGINT) AS out_of_range_total, CAST(dups AS BIGINT) AS duplicate_counts,
            CAST(kinds AS BIGINT) AS anomaly_kinds, score AS quality_score,
            CONCAT_WS(',', CASE WHEN nulls > 0 THEN '{V.ADVICE_NULLS}' END,
              CASE WHEN outs > 0 THEN '{V.ADVICE_RANGES}' END, CASE WHEN dups > 0 THEN '{V.ADVICE_DUPLICATES}' END,
              CASE WHEN score < 90 THEN '{V.ADVICE_SCORE_90}' END, CASE WHEN score < 70 THEN '{V.ADVICE_SCORE_70}' END)
              AS recommendations FROM q)"""


CHECKED_VIEWS = "production_logs equipment_sensors weather_data daily_production_metrics"
CHECK_ROWS = f"""table_name, records_checked, null_total, out_of_range_total, duplicate_counts, anomaly_kinds,
    {nums('quality_score')}, recommendations"""


@query("table_quality", f"WITH {quality_sql(None)} SELECT {CHECK_ROWS} FROM checks", CHECKED_VIEWS)
def table_quality(spark, folder):
    return table_quality_rows(spark, folder).select(*QUALITY_COLUMNS)


def table_quality_rows(spark, folder):
    return reduce(
        DataFrame.unionByName,
        [quality.table_quality(df, name) for name, df in checked_tables(spark, folder).items()],
    )


@query("table_quality_since", f"WITH {quality_sql(SINCE)} SELECT {CHECK_ROWS} FROM checks", CHECKED_VIEWS)
def table_quality_since(spark, folder):
    return P.validate_tables(checked_tables(spark, folder), SINCE).select(*QUALITY_COLUMNS)


STATE_TABLES = ["production_logs", "equipment_sensors"]


def stored_in_two_steps(spark, folder):
    """Tables stored by month, without their newest month first; their states; then the newest month is added."""
    states = new_path(spark, "states")
    for name in STATE_TABLES:
        df, path = checked_tables(spark, folder)[name], new_path(spark, name)
        rows = settle(files.with_month(df, quality.rules_for(name)["date_column"]), name)
        newest = rows.agg(F.max(files.MONTH)).first()[0]
        for step, part in enumerate((F.col(files.MONTH) < newest, F.col(files.MONTH) == newest)):
            rows.where(part).hint("rebalance", files.MONTH).write.partitionBy(files.MONTH).mode("append").parquet(path)
            stored = spark.read.schema(rows.schema).parquet(path)
            if not step:
                check_states.refresh_states(stored, name, states)
        yield name, stored, states


def state_rows(spark, folder, since=None):
    parts = [check_states.quality_from_states(df, name, states, since) for name, df, states in stored_in_two_steps(spark, folder)]
    return reduce(DataFrame.unionByName, parts).select(*QUALITY_COLUMNS)


STATES_WHERE = f"WHERE table_name IN ({', '.join(map(repr, STATE_TABLES))})"


@query("table_quality_states", f"WITH {quality_sql(None)} SELECT {CHECK_ROWS} FROM checks {STATES_WHERE}", CHECKED_VIEWS)
def table_quality_states(spark, folder):
    """The checks of whole tables from the states of their folders."""
    return state_rows(spark, folder)


@query("table_quality_states_since", f"WITH {quality_sql(SINCE)} SELECT {CHECK_ROWS} FROM checks {STATES_WHERE}", CHECKED_VIEWS)
def table_quality_states_since(spark, folder):
    return state_rows(spark, folder, SINCE)


@query(
    "check_states",
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, month, MAX(month) OVER () = month AS read_again, COUNT(*) AS records,
              CAST(COUNT(*) - COUNT(DISTINCT ({', '.join(V.RULES[name]['keys'])})) AS BIGINT) AS duplicates
            FROM (SELECT *, STRFTIME({V.RULES[name]['date_column']}, '%Y-%m') AS month FROM {name}) m GROUP BY month"""
        for name in STATE_TABLES
    ),
    CHECKED_VIEWS,
)
def check_state_rows(spark, folder):
    """States of all folders after the newest month came in; only that folder is read again."""
    parts = []
    for name, df, states in stored_in_two_steps(spark, folder):
        rows, changed = check_states.refresh_states(df, name, states)
        parts.append(rows.select("table_name", F.col("part").alias("month"), F.col("part").isin(changed).alias("read_again"), "records", "duplicates"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "recommendations",
    f"WITH {quality_sql(None)} SELECT table_name, recommendations FROM checks",
    CHECKED_VIEWS,
)
def recommendations(spark, folder):
    return table_quality_rows(spark, folder).select("table_name", "recommendations")


RECENT = """recent AS (SELECT * FROM {table} WHERE date >= (SELECT MAX(date) FROM {table}) - 30)"""
OUTLIERS = f"""SELECT date, metric, {nums('value')}, PRINTF('%.2f - %.2f', lo, hi) AS expected_range,
    CASE WHEN ABS(value - mean) > 3 * std THEN 'high' ELSE 'medium' END AS severity FROM o"""


@query(
    "production_anomalies",
    f"WITH {RECENT.format(table='long_daily').replace('- 30', '- 365')}, {outliers_sql('recent')} {OUTLIERS}",
    "long_daily",
)
def production_anomalies(spark, folder):
    """Outliers of the last year of the long series."""
    return P.production_anomalies(W.stored_daily(spark, folder), days=365)["outliers"]


@query(
    "production_anomalies_long",
    f"WITH {RECENT.format(table='long_daily').replace('- 30', '- 1500')}, {outliers_sql('recent')} {OUTLIERS}",
    "long_daily",
)
def production_anomalies_long(spark, folder):
    """The last 1,500 days of the long series, where outliers occur."""
    return P.production_anomalies(W.stored_daily(spark, folder), days=1500)["outliers"]


ALERTS = f"""SELECT CONCAT_WS(',',
          CASE WHEN l.total_production_daily < m - 2 * s THEN PRINTF('Production significantly below average: %.2f tons',
            l.total_production_daily) END,
          CASE WHEN l.average_quality_grade < 3.0 THEN PRINTF('Poor coal quality detected: %.1f', l.average_quality_grade) END,
          CASE WHEN l.equipment_utilization < 50 THEN PRINTF('Low equipment utilization: %.1f%%', l.equipment_utilization) END,
          CASE WHEN {TREND_CASE} = 'declining' THEN 'Declining production trend detected over the analysis period' END
        ) AS alerts FROM l, a, u"""


@query(
    "threshold_alerts",
    f"""WITH {TREND_SQL.format(table='daily_metrics')},
        a AS (SELECT AVG(total_production_daily) AS m, STDDEV_SAMP(total_production_daily) AS s FROM daily_metrics),
        l AS (SELECT * FROM daily_metrics WHERE date = (SELECT MAX(date) FROM daily_metrics))
        {ALERTS}""",
    "daily_metrics",
)
def threshold_alerts(spark, folder):
    return stats.threshold_alerts(settle(fixture_daily(spark, folder), "daily"))


@query(
    "production_statistics_long",
    f"""WITH {RECENT.format(table='long_daily').replace('- 30', '- 1500')}, a AS ({stats_sql('recent', V.METRICS)})
        SELECT metric, {nums('mean', 'std', 'q1', 'q3')}, {num('q3 - q1', 'iqr')} FROM a""",
    "long_daily",
)
def production_statistics_long(spark, folder):
    """The statistics section of the anomaly analysis."""
    found = P.production_anomalies(W.stored_daily(spark, folder), days=1500)["statistics"]
    return found.select("metric", "mean", "std", "q1", "q3", "iqr")


@query(
    "production_alerts",
    f"""WITH recent AS (SELECT * FROM daily_metrics WHERE date >= (SELECT MAX(date) FROM daily_metrics) - 30),
        {TREND_SQL.format(table='recent')},
        a AS (SELECT AVG(total_production_daily) AS m, STDDEV_SAMP(total_production_daily) AS s FROM recent),
        l AS (SELECT * FROM recent WHERE date = (SELECT MAX(date) FROM recent))
        {ALERTS}""",
    "daily_metrics",
)
def production_alerts(spark, folder):
    """The alerts section of the anomaly analysis."""
    return P.production_anomalies(settle(fixture_daily(spark, folder), "daily"))["alerts"]


def quality_entries_sql() -> str:
    """One row per table, kind of finding and column."""
    parts = []
    for name, rule in V.RULES.items():
        for column in [c for c in CHECKED_COLUMNS[name]]:
            parts.append(f"SELECT '{name}' AS table_name, 'null' AS kind, '{column}' AS column_name, COUNT(*) - COUNT({column}) AS found, '' AS expected FROM {name}")
        for column, (low, high) in rule["ranges"].items():
            test = f"COUNT(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
            parts.append(f"SELECT '{name}', 'range', '{column}', {test}, '' FROM {name}")
            parts.append(f"SELECT '{name}', 'out_of_range', '{column}', {test}, '{low}-{high}' FROM {name}")
        for column, values in rule["allowed"].items():
            test = f"COUNT(*) FILTER (WHERE {column} IS NULL OR {column} NOT IN ({', '.join(repr(v) for v in values)}))"
            parts.append(f"SELECT '{name}', 'invalid_values', '{column}', {test}, '{','.join(values)}' FROM {name}")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") e WHERE found > 0"


@query("table_quality_entries", quality_entries_sql(), CHECKED_VIEWS)
def table_quality_entries(spark, folder):
    """The maps and the list of anomalies of the quality checks, one row per entry."""
    return quality_entries(table_quality_rows(spark, folder))


def quality_entries(rows: DataFrame) -> DataFrame:
    def counts(kind: str, name: str) -> DataFrame:
        entries = rows.select("table_name", F.explode(name).alias("column_name", "found"))
        return entries.select("table_name", F.lit(kind).alias("kind"), "column_name", "found", F.lit("").alias("expected"))

    anomaly = rows.select("table_name", F.explode("anomalies").alias("a"))
    expected = F.coalesce("a.expected_range", F.array_join("a.allowed_values", ","))
    listed = anomaly.select("table_name", F.col("a.type").alias("kind"), F.col("a.column").alias("column_name"), F.col("a.count").alias("found"), expected.alias("expected"))
    return counts("null", "null_counts").unionByName(counts("range", "out_of_range_counts")).unionByName(listed)


COMPLETENESS = f"""d AS (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '{SINCE}', DATE '{UNTIL}', INTERVAL 1 DAY)) AS DATE) AS date),
    g AS (SELECT STRING_AGG(STRFTIME(date, '%Y-%m-%d'), ',' ORDER BY date) AS missing, COUNT(*) AS k FROM d
          WHERE date NOT IN (SELECT date FROM weather_data)),
    w AS (SELECT COUNT(DISTINCT date) AS actual FROM weather_data
          WHERE date >= DATE '{SINCE}' AND date <= DATE '{UNTIL}'),
    e AS (SELECT COUNT(*) AS expected FROM d)"""


@query(
    "weather_completeness",
    f"""WITH {COMPLETENESS} SELECT '{SINCE}' AS start_date, '{UNTIL}' AS end_date, expected AS expected_days,
          actual AS actual_days, COALESCE(missing, '') AS missing_dates,
          {num('actual / expected * 100', 'completeness_percentage')}, k = 0 AS data_complete FROM g, w, e""",
    "weather_data",
)
def weather_completeness(spark, folder):
    return P.weather_completeness(W.weather_data(spark, folder), SINCE, UNTIL)


@query(
    "validation_report",
    f"""WITH {quality_sql(SINCE)}, {RECENT.format(table='daily_metrics')}, {outliers_sql('recent')}, {COMPLETENESS},
        a AS (SELECT AVG(quality_score) AS mean, COUNT(*) FILTER (WHERE quality_score < 70) AS critical FROM checks),
        z AS (SELECT COUNT(*) AS found FROM o)
        SELECT {num('mean', 'average_quality_score')}, CASE WHEN mean >= 95 THEN 'excellent' WHEN mean >= 85 THEN 'good'
            WHEN mean >= 70 THEN 'fair' ELSE 'poor' END AS data_health, critical AS critical_issues,
          found AS total_anomalies, k = 0 AS weather_data_complete,
          CONCAT_WS(',', CASE WHEN mean < 85 THEN '{V.ADVICE_REPORT_SCORE}' END,
            CASE WHEN found > 5 THEN '{V.ADVICE_REPORT_ANOMALIES}' END,
            CASE WHEN k > 0 THEN '{V.ADVICE_REPORT_WEATHER}' END) AS recommendations
        FROM a, z, g""",
    CHECKED_VIEWS + " daily_metrics",
)
def validation_report(spark, folder):
    return P.validation_report(checked_tables(spark, folder), SINCE, UNTIL)["overall"]


@query(
    "validation_document",
    f"""WITH {quality_sql(SINCE)}, e AS (SELECT table_name, quality_score FROM checks)
        SELECT 'table_validations' AS section, table_name AS name, {num('quality_score', 'value')} FROM checks
        UNION ALL SELECT 'overall_assessment', 'average_quality_score', {num('AVG(quality_score)', 'value')} FROM checks
        UNION ALL SELECT 'overall_assessment', 'critical_issues', {num('COUNT(*) FILTER (WHERE quality_score < 70)', 'value')} FROM checks
        UNION ALL SELECT 'statistical_summary', metric, {num('mean', 'value')}
          FROM ({stats_sql('(SELECT * FROM daily_metrics WHERE date >= (SELECT MAX(date) FROM daily_metrics) - 30)', V.METRICS)}) a
        UNION ALL SELECT 'weather_completeness', 'actual_days', {num('COUNT(DISTINCT date)', 'value')} FROM weather_data
          WHERE date >= DATE '{SINCE}' AND date <= DATE '{UNTIL}'
        UNION ALL SELECT 'errors', table_name, {num('0', 'value')} FROM checks""",
    CHECKED_VIEWS + " daily_metrics",
)
def validation_document(spark, folder):
    """The report, stored as JSON, read back and taken apart."""
    path = new_path(spark, "validation")
    document = P.report_document(P.validation_report(checked_tables(spark, folder), SINCE, UNTIL))
    write_json(document, path)
    stored = settle(read_json_report(spark, path, document.schema), "document")

    def rows(section: str, source: str, name: str, value) -> DataFrame:
        inner = stored.select(F.explode(source).alias("r"))
        return inner.select(F.lit(section).alias("section"), F.col(f"r.{name}").alias("name"), value.cast("double").alias("value"))

    def one(section: str, name: str) -> DataFrame:
        return stored.select(F.lit(section).alias("section"), F.lit(name).alias("name"), F.col(f"{section}.{name}").cast("double").alias("value"))

    parts = [
        rows("table_validations", "table_validations", "table_name", F.col("r.quality_score")),
        one("overall_assessment", "average_quality_score"),
        one("overall_assessment", "critical_issues"),
        rows("statistical_summary", "anomaly_analysis.statistical_summary", "metric", F.col("r.mean")),
        one("weather_completeness", "actual_days"),
        rows("errors", "table_validations", "table_name", F.size("r.errors")),
    ]
    return reduce(DataFrame.unionByName, parts)


FEATURES = X.feature_names()
INT_FEATURES = [
    "year", "month", "day", "day_of_year", "week_of_year", "day_of_week", "is_weekend", "high_precipitation", "time_index",
]


def features_sql(rolling: str, names: list[str], rounded: bool = True) -> str:
    """All features, then the drop of incomplete days."""
    exact = INT_FEATURES if rounded else [V.TARGET, *names]
    columns = ", ".join(
        (f"CAST({name} AS BIGINT) AS {name}" if name in INT_FEATURES else name) if name in exact else num(name, name)
        for name in [V.TARGET, *names]
    )
    complete = " AND ".join(f"{name} IS NOT NULL" for name in ["total_production_daily", *names])
    return f"""WITH f AS (SELECT *, {LAG_SQL}, {rolling}, YEAR(date) AS year, MONTH(date) AS month, DAY(date) AS day,
          DAYOFYEAR(date) AS day_of_year, WEEKOFYEAR(date) AS week_of_year, ISODOW(date) - 1 AS day_of_week,
          CASE WHEN ISODOW(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
          average_quality_grade * equipment_utilization AS quality_utilization,
          fuel_efficiency * weather_impact_score AS efficiency_weather,
          equipment_utilization ** 2 AS equipment_utilization_squared,
          LN(1 + equipment_utilization) AS equipment_utilization_log,
          average_quality_grade ** 2 AS average_quality_grade_squared,
          LN(1 + average_quality_grade) AS average_quality_grade_log,
          ABS(temperature_mean - AVG(temperature_mean) OVER ()) AS temp_deviation,
          CASE WHEN precipitation_sum > 5 THEN 1 ELSE 0 END AS high_precipitation,
          ROW_NUMBER() OVER w - 1 AS time_index
        FROM long_daily {WINDOW})
        SELECT date, {columns} FROM f WHERE {complete}"""


@query("feature_table", features_sql(CURRENT, FEATURES), "long_daily")
def feature_table(spark, folder):
    return X.feature_table(W.stored_daily(spark, folder))


@query("feature_table_before", features_sql(EARLIER, X.feature_names(False)), "long_daily")
def feature_table_before(spark, folder):
    """Without the target of the same day in any feature."""
    return X.feature_table(W.stored_daily(spark, folder), include_current=False)


@query(
    "feature_rows_removed",
    f"""WITH f AS ({features_sql(CURRENT, FEATURES)}), k AS (SELECT COUNT(*) AS kept FROM f),
        d AS (SELECT COUNT(*) AS days FROM long_daily) SELECT days, kept, days - kept AS removed FROM d, k""",
    "long_daily",
)
def feature_rows_removed(spark, folder):
    daily = W.stored_daily(spark, folder)
    return X.removed_rows(daily, X.feature_table(daily))


@query(
    "eda_feature_pairs",
    "\nUNION ALL ".join(
        f"SELECT date, {nums('total_production_daily')}, '{name}' AS feature, {num(name, 'feature_value')} FROM long_daily"
        for name in V.BASE_FEATURES
    ),
    "long_daily",
)
def eda_feature_pairs(spark, folder):
    return eda.feature_pairs(W.long_daily(spark, folder))


@query(
    "eda_feature_histograms",
    "\nUNION ALL ".join(histogram_sql("long_daily", name, V.FEATURE_BINS) for name in V.BASE_FEATURES),
    "long_daily",
)
def eda_feature_histograms(spark, folder):
    return eda.feature_histograms(W.stored_daily(spark, folder))


@query("eda_series", f"SELECT date, {nums('total_production_daily')} FROM long_daily", "long_daily")
def eda_series(spark, folder):
    return eda.series(W.long_daily(spark, folder))
