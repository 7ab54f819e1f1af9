"""Checks of stored tables from states per folder, so that a new day costs reading that day.

A table stored by date or month has one folder per value of that column. Its **state** holds what the checks add up: rows,
repeats, and the count of every fault. Since the date is part of the key, equal keys lie in one folder, so the
sums over folders are the figures of the whole table. States are kept in a list that is only appended to, each
with the names of the files it was taken from and with the tests it counted: a folder whose files or tests are others, or
that has no state yet, is read again, all others are not. States of folders that are gone do not count.

Defined cases: rows without a date are a folder of their own; two runs that append the same state count it once; a table without
files has no states and gets the figures of an empty table; a table whose key does not hold its date column is
refused (ValueError), because its repeats may lie in two folders.
"""

import hashlib
import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode.operators import quality
from shiftlode.session import settle
from shiftlode.sources.files import MONTH, scan_since

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SCHEMA = "table_name string, part string, files string, tests string, records long, duplicates long, faults map<string, long>"


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def part_column(df: DataFrame, table: str, rules: dict | None = None) -> str | None:
    """The column a stored table has its folders by, if its states can be added up: the month, or the date itself."""
    date = quality.rules_for(table, rules)["date_column"]
    found = next(iter(df.inputFiles()), "")
    return next((name for name in (MONTH, date) if name in df.columns and f"/{name}=" in found), None)


def stored_parts(df: DataFrame, column: str) -> dict[str, str]:
    """Value of ``column`` (as in the folder's name) and digest of the file names, of every folder. Lists files, reads none."""
    files = defaultdict(list)
    for path in df.inputFiles():
        value = re.search(f"/{re.escape(column)}=([^/]+)/", path)
        files[unquote(unquote(value.group(1)))].append(path.rsplit("/", 1)[1])
    return {part: _digest(sorted(names)) for part, names in files.items()}


def _rows_of(df: DataFrame, column: str, parts: list[str]) -> DataFrame:
    kind = df.schema[column].dataType
    known = [F.lit(part).cast(kind) for part in parts if part != NO_VALUE]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return df.where(wanted | F.col(column).isNull() if NO_VALUE in parts else wanted)


def _signature(df: DataFrame, table: str, rules: dict | None) -> str:
    tests = quality.quality_tests(df.drop(MONTH), table, rules)
    return _digest([*quality.rules_for(table, rules)["keys"], *[f"{name}: {test}" for name, test in tests.items()]])


def states_of(df: DataFrame, table: str, column: str, rules: dict | None = None) -> DataFrame:
    """Records, repeats and faults of every folder (``part``) of a table or of a part of it."""
    rule = quality.rules_for(table, rules)
    if rule["date_column"] not in rule["keys"]:
        raise ValueError(f"the key of {table} does not hold its date, repeats may lie in two folders")
    tests = list(quality.quality_tests(df.drop(MONTH), table, rules))
    part = F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE)).alias("part")
    per_key = quality.counts_per_key(df, table, rules, [part], [MONTH])
    faults = F.map_from_arrays(F.array(*map(F.lit, tests)), F.array(*[F.sum(f"`{name}`") for name in tests]))
    return per_key.groupBy("part").agg(
        F.sum("_rows").alias("records"), F.sum(F.col("_rows") - 1).alias("duplicates"), faults.alias("faults")
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All states that were ever stored; none before the first."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SCHEMA)
        raise


def refresh_states(df: DataFrame, table: str, path: str, rules: dict | None = None) -> tuple[DataFrame, list[str]]:
    """The states of all folders of a stored table, and the folders that were read for it.

    ``df`` is the table as read from its files, ``path`` the list of states (of any number of tables).
    """
    spark, column = df.sparkSession, part_column(df, table, rules)
    if column is None:
        if df.inputFiles():
            raise ValueError(f"{table} is not stored by its date or month")
        return spark.createDataFrame([], SCHEMA), []
    current, tests = stored_parts(df, column), _signature(df, table, rules)
    # One short row per folder, as many as the driver has listed to plan the scan.
    wanted = spark.createDataFrame([(table, part, files, tests) for part, files in current.items()], SCHEMA.split(", records")[0])
    keys = ["table_name", "part", "files", "tests"]

    def known() -> DataFrame:
        return read_states(spark, path).join(wanted, keys).dropDuplicates(keys)

    there = {row.part for row in known().select("part").collect()}
    changed = sorted(set(current) - there)
    if changed:
        rows = df if len(changed) == len(current) else _rows_of(df, column, changed)
        fresh = states_of(rows, table, column, rules).join(wanted, "part").select(*[name.split()[0] for name in SCHEMA.split(", ", 6)])
        fresh.coalesce(1).write.mode("append").parquet(path)
    # Settled, since Spark takes scans of one path for the same, whatever files were there when they were planned.
    return settle(known(), "states"), changed


def _totals(states: DataFrame, tests: list[str]) -> DataFrame:
    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return states.agg(
        total("records").alias("records_checked"),
        total("duplicates").alias("duplicate_counts"),
        *[total(F.col("faults").getItem(name)).alias(name) for name in tests],
    )


def quality_from_states(df: DataFrame, table: str, path: str, since: str | None = None, rules: dict | None = None) -> DataFrame:
    """As :func:`quality.table_quality` of the rows since a day, and ``total_records`` of all days, from refreshed states.

    Of the month that ``since`` lies in the rows are read; whole folders after it come from their states.
    """
    states, _ = refresh_states(df, table, path, rules)
    date = quality.rules_for(table, rules)["date_column"]
    column, plain = part_column(df, table, rules), df.drop(MONTH)
    tests = list(quality.quality_tests(plain, table, rules))
    chosen = states
    if since is not None and column == MONTH:
        part = states_of(scan_since(df.where(F.col(MONTH) == since[:7]), since, date), table, MONTH, rules)
        later = states.where((F.col("part") != NO_VALUE) & (F.col("part") > since[:7]))
        chosen = later.select(*part.columns).unionByName(part)
    elif since is not None:
        chosen = states.where((F.col("part") != NO_VALUE) & (F.col("part") >= since))
    found = quality.assessed(settle(_totals(chosen, tests), "totals"), plain, table, rules)
    return found.withColumn("total_records", settle(states.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")), "records").scalar())
