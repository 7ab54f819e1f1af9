"""Quality report over the warehouse tables."""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import date_text, days_inclusive, health_bucket, present
from shiftlode.operators import filters, quality, stats
from shiftlode.operators.ordered import with_row_index
from shiftlode.plans import check_states
from shiftlode.session import settle
from shiftlode.sources.files import MONTH, calendar_between, scan_since


def production_anomalies(
    daily: DataFrame, days: int = V.RECENT_DAYS, as_of: str | None = None, metrics: Sequence[str] = V.METRICS
) -> dict[str, DataFrame]:
    """Statistics, outliers and alerts of the last days. All are empty below a week.

    The recent days are written once, with their position, for the passes over them, when this is called.
    """
    recent = settle(with_row_index(filters.last_n_days(daily, days, as_of)), "recent")
    summary = stats.metric_stats(recent, metrics)
    return {
        "statistics": summary,
        "outliers": stats.iqr_outliers(recent, metrics, summary),
        "alerts": stats.threshold_alerts(recent, stats.trend_of_indexed(recent, V.TARGET)),
    }


def weather_completeness(weather: DataFrame, start: str, end: str) -> DataFrame:
    """One row: expected and present days of the range, the missing ones, percent."""
    present_days = filters.date_range(weather, start, end).select("date").distinct()
    days = calendar_between(weather.sparkSession, start, end).join(
        present_days.withColumn("_there", F.lit(True)), "date", "left"
    )
    missing = F.when(F.col("_there").isNull(), date_text(F.col("date")))
    found = days.agg(
        F.count("*").alias("expected_days"),
        F.count("_there").alias("actual_days"),
        F.array_sort(F.collect_list(missing)).alias("missing_dates"),
    )
    return found.select(
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        days_inclusive(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("expected_days"),
        "actual_days",
        "missing_dates",
        F.when(F.col("expected_days") > 0, F.col("actual_days") / F.col("expected_days") * 100)
        .otherwise(F.lit(0.0))
        .alias("completeness_percentage"),
        (F.size("missing_dates") == 0).alias("data_complete"),
    )


def _table_checks(name: str, df: DataFrame, since: str | None, states: str | None = None) -> DataFrame:
    """Structure and quality of one table. Without ``since`` one pass gives both; with it the
    checks skip older files, and the count of all records reads no column. With ``states`` only
    folders of the table that are new or changed are read."""
    rule = quality.rules_for(name)
    column = rule["date_column"]
    limited = since is not None and column in df.columns
    if states is not None and column in rule["keys"] and check_states.part_column(df, name):
        found = check_states.quality_from_states(df, name, states, since)
        total = F.col("total_records")
    else:
        checked = scan_since(df, since, column) if limited else df
        found = quality.table_quality(checked.drop(MONTH), name)
        total = df.agg(F.count("*")).scalar() if limited else F.col("records_checked")
    missing = quality.missing_columns(df, name)
    structure = F.struct(
        F.lit(not missing).alias("structure_valid"),
        (F.array(*map(F.lit, missing)) if missing else F.array().cast("array<string>")).alias("missing_fields"),
        total.alias("total_records"),
    )
    found = found.withColumn("structure", structure).drop("total_records")
    return found.withColumn("errors", F.array().cast("array<string>"))


def _failed(spark, name: str, error: Exception) -> DataFrame:
    """The row of a table that could not be checked."""
    text = (str(error).strip().splitlines() or [type(error).__name__])[0]
    return spark.createDataFrame([(name, [text])], "table_name string, errors array<string>")


def validate_tables(
    tables: dict[str, DataFrame], since: str | None = V.REPORT_SINCE, expected: Sequence[str] = (), states: str | None = None
) -> DataFrame:
    """Structure and quality, one row per table, written once. ``states`` is the path of the check states, if they
    are kept (see :mod:`check_states`); the tables have to come as read from their files.

    A table that is ``expected`` but not there, or that cannot be read or checked, gets a row with the text in
    ``errors`` and no figures; the others go on. All tables are checked in one run; only if that fails are
    they run one by one.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = {name: _failed(spark, name, KeyError(f"table {name} is not there")) for name in expected if name not in tables}
    whole = {}
    for name, df in tables.items():
        try:
            whole[name] = _table_checks(name, df, since, states)
        except AnalysisException as error:
            parts[name] = _failed(spark, name, error)
    try:
        return settle(_united([*whole.values(), *parts.values()]), "checks")
    except PySparkException:
        for name, rows in whole.items():
            try:
                parts[name] = settle(rows, "checks")
            except PySparkException as error:
                parts[name] = _failed(spark, name, error)
        return settle(_united(list(parts.values())), "checks")


def _united(parts: list[DataFrame]) -> DataFrame:
    """Rows with all columns first, so that rows of failed tables get NULLs."""
    ordered = sorted(parts, key=lambda part: -len(part.columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ordered)


def overall_assessment(
    tables: DataFrame, anomalies: Column, weather_complete: Column, limit: float = V.REPORT_SCORE_LIMIT
) -> DataFrame:
    """One row: mean score, health, critical tables, anomalies, completeness, advice."""
    scores = tables.agg(
        F.avg("quality_score").alias("average_quality_score"),
        F.count_if(F.col("quality_score") < V.CRITICAL_SCORE).alias("critical_issues"),
    )
    mean = F.col("average_quality_score")
    return scores.select(
        "average_quality_score",
        health_bucket(mean).alias("data_health"),
        "critical_issues",
        anomalies.alias("total_anomalies"),
        weather_complete.alias("weather_data_complete"),
    ).withColumn(
        "recommendations",
        present(
            F.when(mean < limit, V.ADVICE_REPORT_SCORE),
            F.when(F.col("total_anomalies") > V.REPORT_ANOMALY_LIMIT, V.ADVICE_REPORT_ANOMALIES),
            F.when(~F.col("weather_data_complete"), V.ADVICE_REPORT_WEATHER),
        ),
    )


def validation_report(
    tables: dict[str, DataFrame],
    since: str = V.REPORT_SINCE,
    weather_until: str = V.REPORT_WEATHER_UNTIL,
    days: int = V.RECENT_DAYS,
    as_of: str | None = None,
    states: str | None = None,
) -> dict[str, DataFrame]:
    """All sections of the report; each is a small DataFrame. With the path ``states`` a run reads only
    the folders of the stored tables that are new since the last one."""
    checks = validate_tables(tables, since, list(V.RULES), states)
    recent = production_anomalies(tables["daily_production_metrics"], days, as_of)
    completeness = weather_completeness(tables["weather_data"], since, weather_until)
    overall = overall_assessment(
        checks,
        recent["outliers"].agg(F.count("*")).scalar(),
        completeness.select("data_complete").scalar(),
    )
    return {"tables": checks, **recent, "weather_completeness": completeness, "overall": overall}


def report_document(report: dict[str, DataFrame]) -> DataFrame:
    """The report as one row with one nested column per section, to be written as JSON.

    The sections are summaries: four tables, five metrics, the outliers of the recent
    days and the missing dates of one range.
    """

    def rows(df: DataFrame) -> Column:
        return df.agg(F.collect_list(F.struct(*df.columns))).scalar()

    def row(df: DataFrame) -> Column:
        return df.select(F.struct(*df.columns)).scalar()

    base = report["overall"].select(
        F.date_format(F.localtimestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("report_date"),
        F.struct(*[name for name in report["overall"].columns if name != "recommendations"]).alias(
            "overall_assessment"
        ),
        "recommendations",
    )
    return base.withColumns(
        {
            "table_validations": rows(report["tables"]),
            "anomaly_analysis": F.struct(
                rows(report["statistics"]).alias("statistical_summary"),
                rows(report["outliers"]).alias("anomalies_detected"),
                report["alerts"].scalar().alias("alerts"),
            ),
            "weather_completeness": row(report["weather_completeness"]),
        }
    )
