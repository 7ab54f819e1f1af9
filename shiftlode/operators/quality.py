"""Quality checks of one table: a single aggregate pass plus one count per key.

Nothing but one summary row per table leaves the executors.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import present, salt_of

SALTS = 64
ANOMALIES = (
    "ARRAY<STRUCT<type: STRING, column: STRING, count: BIGINT, expected_range: STRING, allowed_values: ARRAY<STRING>>>"
)
NO_RULES = {"ranges": {}, "allowed": {}, "required": [], "keys": [], "date_column": None}


def rules_for(table: str, rules: dict | None = None) -> dict:
    return (rules or V.RULES).get(table, NO_RULES)


def missing_condition(df: DataFrame, name: str) -> str:
    """SQL condition for NULL, or NaN in a floating column."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return f"`{name}` IS NULL OR isnan(`{name}`)" if floating else f"`{name}` IS NULL"


def _missing_conditions(df: DataFrame) -> dict[str, str]:
    return {name: missing_condition(df, name) for name in df.columns}


def _range_conditions(df: DataFrame, rules: dict) -> dict[str, str]:
    """A missing value is not out of range."""
    return {
        name: f"`{name}` < {low} OR `{name}` > {high}"
        for name, (low, high) in rules["ranges"].items()
        if name in df.columns
    }


def _domain_conditions(df: DataFrame, rules: dict) -> dict[str, str]:
    """A missing value is not one of the allowed values."""
    return {
        name: f"`{name}` IS NULL OR `{name}` NOT IN ({_texts(values)})"
        for name, values in rules["allowed"].items()
        if name in df.columns
    }


def _texts(values: Sequence[str]) -> str:
    return ", ".join("'" + value.replace("'", "\\'") + "'" for value in values)


def _count_columns(df: DataFrame, conditions: dict[str, str], kind: str) -> DataFrame:
    """One row per condition with its count, from one pass over the table."""
    if not conditions:
        return df.sparkSession.createDataFrame([], f"column_name string, {kind} long")
    rows = ", ".join(f"struct('{name}' AS column_name, count_if({test}) AS {kind})" for name, test in conditions.items())
    return df.agg(F.expr(f"array({rows})").alias("found")).select(F.inline("found"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many."""
    return _count_columns(df, _missing_conditions(df), "null_count").where(F.col("null_count") > 0)


def out_of_range_counts(df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    return _count_columns(df, _range_conditions(df, rules_for(table, rules)), "out_of_range")


def invalid_value_counts(df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    return _count_columns(df, _domain_conditions(df, rules_for(table, rules)), "invalid")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _count_columns(df, {name: missing_condition(df, name) for name in columns}, "violations")


def duplicate_count(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first per key; missing key values count as equal. Without keys
    the whole row is the key. Counting per key before the shuffle keeps a key with very
    many copies at one row per task."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("rows"))
    return groups.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_count"))


def duplicate_flags(df: DataFrame, keys: Sequence[str], order: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Mark every row but the first (by ``order``) of its key; missing keys are equal.

    The rows of a key are spread over ``salts`` groups. All but the first of a group are
    duplicates at once and do not move again. Only the firsts, at most ``salts`` per key,
    go on to be compared with each other. Both branches read the same shuffle.
    """
    spread = df.withColumn("_salt", salt_of(salts, *order))
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    # A lag, since a row number invites a limit below the shuffle in one branch only.
    marked = spread.withColumn("_behind", F.lag(F.lit(True), 1, False).over(local))
    final = Window.partitionBy(*keys).orderBy(*order)
    firsts = marked.where(~F.col("_behind")).withColumn("is_duplicate", F.lag(F.lit(True), 1, False).over(final))
    others = marked.where("_behind").withColumn("is_duplicate", F.lit(True))
    return firsts.unionByName(others).select(*df.columns, "is_duplicate")


def quality_score(nulls: Column, out_of_range: Column, duplicates: Column, kinds: Column, rows: Column) -> Column:
    """100 less capped points; an empty table keeps 100."""

    def part(count, points, cap):
        return F.least(count / rows * 100.0 * points, F.lit(cap))

    score = (
        F.lit(100.0)
        - part(nulls, V.NULL_POINTS, V.NULL_CAP)
        - part(out_of_range, V.RANGE_POINTS, V.RANGE_CAP)
        - part(duplicates, V.DUPLICATE_POINTS, V.DUPLICATE_CAP)
        - F.least(kinds * V.ANOMALY_POINTS, F.lit(V.ANOMALY_CAP))
    )
    return F.when(rows > 0, F.greatest(score, F.lit(0.0))).otherwise(F.lit(100.0))


def recommendations(nulls: Column, out_of_range: Column, duplicates: Column, score: Column) -> Column:
    return present(
        F.when(nulls > 0, V.ADVICE_NULLS),
        F.when(out_of_range > 0, V.ADVICE_RANGES),
        F.when(duplicates > 0, V.ADVICE_DUPLICATES),
        F.when(score < 90, V.ADVICE_SCORE_90),
        F.when(score < 70, V.ADVICE_SCORE_70),
    )


def _nonzero(prefix: str, names: Sequence[str]) -> Column:
    """Map of column name -> count, without the zero counts."""
    pairs = ", ".join(f"'{name}', `{prefix}{name}`" for name in names)
    source = f"map({pairs})" if pairs else "CAST(map() AS MAP<STRING, BIGINT>)"
    return F.expr(f"map_filter({source}, (name, found) -> found > 0)")


def _total(prefix: str, names: Sequence[str]) -> Column:
    return F.expr(" + ".join(["0L", *[f"`{prefix}{name}`" for name in names]]))


def _anomalies(rule: dict, ranges: Sequence[str], domains: Sequence[str]) -> Column:
    """One entry per kind of issue found: first the ranges, then the allowed values."""
    entries = []
    for name in ranges:
        low, high = rule["ranges"][name]
        entries.append(("out_of_range", name, f"range_{name}", f"'{low}-{high}'", "CAST(NULL AS ARRAY<STRING>)"))
    for name in domains:
        allowed = f"array({_texts(rule['allowed'][name])})"
        entries.append(("invalid_values", name, f"domain_{name}", "CAST(NULL AS STRING)", allowed))
    if not entries:
        return F.expr(f"CAST(array() AS {ANOMALIES})")
    items = ", ".join(
        f"IF(`{count}` > 0, struct('{kind}' AS type, '{name}' AS column, `{count}` AS count,"
        f" {expected} AS expected_range, {allowed} AS allowed_values), NULL)"
        for kind, name, count, expected, allowed in entries
    )
    return F.expr(f"array_compact(array({items}))")


def quality_tests(df: DataFrame, table: str, rules: dict | None = None) -> dict[str, str]:
    """SQL condition of every counted fault of a table; the names start with the kind."""
    rule = rules_for(table, rules)
    groups = {
        "null_": _missing_conditions(df),
        "range_": _range_conditions(df, rule),
        "domain_": _domain_conditions(df, rule),
    }
    return {f"{prefix}{name}": test for prefix, found in groups.items() for name, test in found.items()}


def counts_per_key(
    df: DataFrame, table: str, rules: dict | None = None, by: Sequence[Column] = (), ignored: Sequence[str] = ()
) -> DataFrame:
    """Rows (``_rows``) and faults of every key, for every value of ``by``; columns that are ``ignored`` are not checked."""
    checked = df.drop(*ignored)
    names = rules_for(table, rules)["keys"] or checked.columns
    keys = [F.col(name).alias(f"_key_{number}") for number, name in enumerate(names)]
    tests = quality_tests(checked, table, rules)
    return df.groupBy(*by, *keys).agg(
        F.count("*").alias("_rows"), *[F.expr(f"count_if({test})").alias(name) for name, test in tests.items()]
    )


def table_quality(df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    """One row with all checks of the table, its score and recommendations.

    One pass: the counts of all checks are taken per key, combined before the shuffle, and summed
    up; the keys then also say how many rows are repeats.
    """
    per_key = counts_per_key(df, table, rules)

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    totals = per_key.agg(
        total("_rows").alias("records_checked"),
        total(F.col("_rows") - 1).alias("duplicate_counts"),
        *[total(f"`{name}`").alias(name) for name in quality_tests(df, table, rules)],
    )
    return assessed(totals, df, table, rules)


def assessed(totals: DataFrame, df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    """Score, anomalies and recommendations from a row with ``records_checked``, ``duplicate_counts`` and all fault counts."""
    rule, tests = rules_for(table, rules), quality_tests(df, table, rules)
    ranges = [name.removeprefix("range_") for name in tests if name.startswith("range_")]
    domains = [name.removeprefix("domain_") for name in tests if name.startswith("domain_")]
    nulls, outs, duplicates = F.col("null_total"), F.col("out_of_range_total"), F.col("duplicate_counts")
    return (
        totals.select(
            F.lit(table).alias("table_name"),
            "records_checked",
            _nonzero("null_", df.columns).alias("null_counts"),
            _total("null_", df.columns).alias("null_total"),
            _nonzero("range_", ranges).alias("out_of_range_counts"),
            _total("range_", ranges).alias("out_of_range_total"),
            "duplicate_counts",
            _anomalies(rule, ranges, domains).alias("anomalies"),
        )
        .withColumn("anomaly_kinds", F.size("anomalies"))
        .withColumn(
            "quality_score",
            quality_score(nulls, outs, duplicates, F.col("anomaly_kinds"), F.col("records_checked")),
        )
        .withColumn("recommendations", recommendations(nulls, outs, duplicates, F.col("quality_score")))
    )


def missing_columns(df: DataFrame, table: str, rules: dict | None = None) -> list[str]:
    return [name for name in rules_for(table, rules)["required"] if name not in df.columns]


def table_structure(df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    """One row: required columns that are missing and the number of records."""
    missing = missing_columns(df, table, rules)
    return df.agg(F.count("*").alias("total_records")).select(
        F.lit(table).alias("table_name"),
        F.lit(not missing).alias("structure_valid"),
        (F.array(*map(F.lit, missing)) if missing else F.array().cast("array<string>")).alias("missing_fields"),
        "total_records",
    )

