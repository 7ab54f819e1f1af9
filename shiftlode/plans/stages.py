"""The three stages in order: load and transform, validate, forecast."""

import logging
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import aggregates as A
from shiftlode.operators import constraints as C
from shiftlode.plans import daily as D
from shiftlode.plans.eda import eda_tables
from shiftlode.plans.forecast import run_forecast, save_results
from shiftlode.plans.validation import report_document, validation_report
from shiftlode.sinks import versions
from shiftlode.sinks.tables import (
    append_quality_log,
    full_refresh,
    used_slot,
    with_created_at,
    with_generated_id,
    write_json,
)
from shiftlode.sources import dump, files

log = logging.getLogger(__name__)


def extract(spark: SparkSession, dump_path: str, sensor_path: str, payload_path: str) -> dict[str, DataFrame]:
    """The four source tables as they are found; records of the dump that cannot be read are
    marked in ``_reject``."""
    pieces = dump.read_statements(spark, dump_path)
    return {
        "mines": dump.mine_records(spark, dump_path, pieces),
        "production_logs": dump.production_records(spark, dump_path, pieces),
        "equipment_sensors": files.read_sensor_csv(spark, sensor_path),
        "weather_data": files.read_weather_payloads(spark, payload_path),
    }


def load(
    df: DataFrame,
    name: str,
    path: str,
    references: dict[str, DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **options,
):
    """Check the constraints of a table, ``finish`` its good rows and store them with their ids.

    Returns the stored table, the counts of broken constraints and the marked source rows. The counts are
    observed during the one write; the source is read again only to keep rejected rows, if any.
    """
    rules = C.Constraints(tuple(V.NOT_NULL[name]), tuple(V.UNIQUE.get(name, ())), references or {})
    marked = C.with_reason(df, rules)
    seen = Observation(f"load-{name}-{uuid.uuid4().hex}")
    rows = finish(C.good_rows(marked.observe(seen, F.count("*").alias("rows"), *C.reason_counts(rules))))
    if name in V.ID_COLUMNS:
        rows = with_generated_id(rows, V.ID_COLUMNS[name])
    stored = full_refresh(rows, path, **options)
    counts = {reason: number for reason, number in seen.get.items() if reason != "rows" and number}
    return stored, counts, marked


def rejection_issues(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """Rows for the quality log: one per table and broken constraint."""
    rows = [
        (name, f"rejected_{reason}", f"Rejected {number} records: {reason}", number, V.ISSUE_SEVERITY)
        for name, found in counts.items()
        for reason, number in found.items()
    ]
    columns = "table_name string, anomaly_type string, description string, affected_records int, severity string"
    return spark.createDataFrame(rows, columns)


def run_etl(spark: SparkSession, sources: dict[str, DataFrame], warehouse: str) -> dict[str, DataFrame]:
    """Refresh the source tables (parents first), build and store the daily table.

    Rows that break a declared constraint go to ``rejected_rows`` and their counts to the quality log. The
    stored records keep their raw values; production is partitioned by date, sensors by
    month. Every source is read once: the days of the calendar come from the stored records,
    cleaning and its counts happen on the way to the daily table. At the end one entry publishes all
    tables (:func:`shiftlode.sinks.versions.read_version`), so its readers never see new mines with old records.
    """
    warehouse = warehouse.rstrip("/")
    tables: dict[str, DataFrame] = {}
    counts, marked = {}, {}

    def store(name: str, df: DataFrame, **options) -> None:
        tables[name], counts[name], marked[name] = load(df, name, f"{warehouse}/{name}", **options)

    store("mines", sources["mines"])
    store("production_logs", sources["production_logs"], references={"mine_id": tables["mines"]}, partition_by=["date"])
    store("equipment_sensors", files.with_month(sources["equipment_sensors"]), partition_by=[files.MONTH])
    days = files.calendar(A.date_bounds(tables["production_logs"]))
    store("weather_data", sources["weather_data"], finish=lambda rows: files.weather_with_defaults(days, rows))
    parts = [C.rejected_rows(marked[name].drop(files.MONTH), name) for name, found in counts.items() if found]
    none = spark.createDataFrame([], "table_name string, reason string, record string")
    tables["rejected_rows"] = full_refresh(reduce(DataFrame.unionByName, parts, none), f"{warehouse}/rejected_rows")

    daily, issues = D.daily_with_issues(tables["production_logs"], tables["equipment_sensors"], tables["weather_data"])
    try:
        append_quality_log(issues.unionByName(rejection_issues(spark, counts)), f"{warehouse}/data_quality_log")
    except Exception:
        log.exception("the quality log could not be written")
    tables["daily_production_metrics"] = full_refresh(
        with_created_at(with_generated_id(daily, V.ID_COLUMNS["daily_production_metrics"])),
        f"{warehouse}/daily_production_metrics",
    )
    stored = {name: (f"{name}/{used_slot(spark, f'{warehouse}/{name}')}", df.schema) for name, df in tables.items()}
    versions.publish(spark, warehouse, stored)
    return tables


def logical(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables to check, without generated columns."""
    return {name: tables[name].drop(V.ID_COLUMNS[name], "created_at") for name in V.RULES}


def run_all(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    warehouse: str,
    since: str = V.REPORT_SINCE,
    weather_until: str = V.REPORT_WEATHER_UNTIL,
    grids: dict[str, dict] | None = None,
    **options,
) -> dict:
    """All stages. A failing load stops the run, a failing validation is only reported."""
    tables = run_etl(spark, sources, warehouse)
    result = {"tables": tables, "summary": A.run_summary(tables["daily_production_metrics"])}
    try:
        report = validation_report(logical(tables), since, weather_until)
        write_json(report_document(report), f"{warehouse.rstrip('/')}/validation_report")
        result["report"] = report
    except Exception:
        log.exception("validation failed, going on")
    daily = logical(tables)["daily_production_metrics"].drop("anomaly_flags")
    result["eda"] = eda_tables(daily)
    result["forecast"] = run_forecast(daily, grids, **options)
    save_results(result["forecast"], warehouse)
    return result
