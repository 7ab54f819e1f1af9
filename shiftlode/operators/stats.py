"""Statistics of the daily table: summaries, outliers, trend, correlation, histograms.

Each is one aggregate over all wanted columns at once. Exact percentiles keep the
distinct values of a column, which the one-row-per-day table bounds by its days; for
raw records pass ``by_bins=True`` (exact, some passes more) or ``approximate=True``.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlode import fixed_values as V
from shiftlode.functions.scalars import as_double, fixed_text, range_text, severity
from shiftlode.operators.ordered import with_block_rows
from shiftlode.operators.selection import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def _value(name: str) -> str:
    """SQL for the column as a double with NaN as NULL."""
    return f"nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE))"


# Statistics by name; {v} is the value and {q} the quantile function.
SPREAD = {
    "mean": "avg({v})",
    "std": "stddev_samp({v})",
    "min": "min({v})",
    "q1": "{q}({v}, 0.25)",
    "median": "{q}({v}, 0.5)",
    "q3": "{q}({v}, 0.75)",
    "max": "max({v})",
}
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _summary(
    df: DataFrame, names: Sequence[str], label: str, parts: dict[str, str], approximate: bool, by_bins: bool
) -> DataFrame:
    """One row per column with the number of rows and the statistics, from one pass (and those over bins)."""
    if by_bins:
        rest = {part: sql for part, sql in parts.items() if part not in QUARTILES}
        found = exact_quantiles(df, names, list(QUARTILES.values())).drop("count")
        quartiles = found.toDF(label, *QUARTILES)  # one row per named column
        joined = _summary(df, names, label, rest, approximate, False).join(F.broadcast(quartiles), label)
        return joined.select(label, "rows", *parts)
    quantile = "percentile_approx" if approximate else "percentile"
    rows = []
    for name in names:
        fields = [f"{sql.format(v=_value(name), q=quantile)} AS `{part}`" for part, sql in parts.items()]
        rows.append(f"struct('{name}' AS {label}, count(*) AS rows, {', '.join(fields)})")
    return df.agg(F.expr(f"array({', '.join(rows)})").alias("found")).select(F.inline("found"))


def describe_table(
    df: DataFrame, names: Sequence[str] | None = None, approximate: bool = False, by_bins: bool = False
) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    parts = {"count": "count({v})", **SPREAD}
    return _summary(df, names or numeric_columns(df), "column_name", parts, approximate, by_bins).drop("rows")


def metric_stats(
    daily: DataFrame, metrics: Sequence[str] = V.METRICS, approximate: bool = False, by_bins: bool = False
) -> DataFrame:
    """mean, std, q1, q3, iqr, min and max per metric; nothing for less than a week."""
    stats = _summary(daily, metrics, "metric", SPREAD, approximate, by_bins)
    return (
        stats.where(F.col("rows") >= V.MIN_ROWS_FOR_STATS)
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .select("metric", "mean", "std", "q1", "q3", "iqr", "min", "max")
    )


def to_long(daily: DataFrame, metrics: Sequence[str] = V.METRICS) -> DataFrame:
    return daily.select("date", *[as_double(F.col(name)).alias(name) for name in metrics]).unpivot(
        ["date"], list(metrics), "metric", "value"
    )


def iqr_outliers(daily: DataFrame, metrics: Sequence[str] = V.METRICS, stats: DataFrame | None = None) -> DataFrame:
    """Values outside q1 - 1.5 iqr .. q3 + 1.5 iqr, with the range as text and a severity.

    The broadcast side has one row per named metric.
    """
    stats = metric_stats(daily, metrics) if stats is None else stats
    low = F.col("q1") - V.IQR_FACTOR * F.col("iqr")
    high = F.col("q3") + V.IQR_FACTOR * F.col("iqr")
    value = F.col("value")
    return (
        to_long(daily, metrics)
        .join(F.broadcast(stats), "metric")
        .where((value < low) | (value > high))
        .select(
            "date", "metric", "value",
            range_text(low, high).alias("expected_range"),
            severity(value, F.col("mean"), F.col("std")).alias("severity"),
        )
    )


def trend(
    daily: DataFrame, value: str = V.TARGET, threshold: float = V.TREND_THRESHOLD, order: str = "date"
) -> DataFrame:
    """One row: the slope of the value over its position, relative to the mean.

    Rows are numbered within blocks only. A block gives its size and the moments of value and position within
    it; running sizes shift the positions, and the blocks are put together around the common means, so no
    row gets its number by a join. Rows without an order value count for the mean alone.
    """
    numbered = with_block_rows(daily.select(order, value), order)
    x = F.when(F.col(value).isNotNull(), F.col("_row").cast("double"))
    y = F.col(value)
    blocks = numbered.groupBy("_block", "_loose").agg(
        F.count("*").alias("rows"),
        F.count("_row").alias("places"),
        F.count(y).alias("values"),
        F.avg(y).alias("level"),
        F.count(x).alias("points"),
        F.avg(x).alias("x"),
        F.avg(F.when(x.isNotNull(), y)).alias("y"),
        (F.covar_pop(x, y) * F.count(x)).alias("xy"),
        (F.var_pop(x) * F.count(x)).alias("xx"),
    )
    earlier = Window.orderBy(F.col("_block").asc_nulls_last(), "_loose").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    points = F.sum("points").over(every)
    placed = blocks.withColumn("x", F.col("x") + F.coalesce(F.sum("places").over(earlier), F.lit(0))).select(
        "*",
        (F.col("x") - F.sum(F.col("x") * F.col("points")).over(every) / points).alias("dx"),
        (F.col("y") - F.sum(F.col("y") * F.col("points")).over(every) / points).alias("dy"),
    )
    products = F.sum(F.coalesce("xy", F.lit(0.0)) + F.coalesce(F.col("points") * F.col("dx") * F.col("dy"), F.lit(0.0)))
    squares = F.sum(F.coalesce("xx", F.lit(0.0)) + F.coalesce(F.col("points") * F.col("dx") * F.col("dx"), F.lit(0.0)))
    fit = placed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.try_divide(products, squares).alias("slope"),
        F.try_divide(F.sum(F.col("level") * F.col("values")), F.sum("values")).alias("mean"),
    )
    return _judged(fit, threshold)


def trend_of_indexed(indexed: DataFrame, value: str, threshold: float = V.TREND_THRESHOLD) -> DataFrame:
    """As :func:`trend`, for rows that have their position."""
    fit = indexed.agg(
        F.count("*").alias("rows"),
        F.regr_slope(F.col(value), F.col("time_index").cast("double")).alias("slope"),
        F.avg(value).alias("mean"),
    )
    return _judged(fit, threshold)


def _judged(fit: DataFrame, threshold: float) -> DataFrame:
    relative = F.when(F.col("mean") != 0, F.col("slope") / F.col("mean")).otherwise(F.lit(0.0))
    direction = (
        F.when(F.col("rows") < V.MIN_ROWS_FOR_TREND, "insufficient_data")
        .when(F.col("relative_slope") > threshold, "increasing")
        .when(F.col("relative_slope") < -threshold, "declining")
        .otherwise("stable")
    )
    return fit.withColumn("relative_slope", relative).withColumn("trend", direction)


def latest_values(daily: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: the values of the newest day."""
    return daily.agg(F.max("date").alias("date"), *[F.max_by(name, "date").alias(name) for name in names])


def threshold_alerts(daily: DataFrame, production_trend: DataFrame | None = None) -> DataFrame:
    """One row with the alert texts for the newest day and the trend; none below a week."""
    production_trend = trend(daily) if production_trend is None else production_trend
    newest = daily.agg(
        F.count("*").alias("rows"),
        F.avg(V.TARGET).alias("mean"),
        F.stddev_samp(V.TARGET).alias("std"),
        *[
            F.max_by(as_double(F.col(name)), "date").alias(name)
            for name in (V.TARGET, "equipment_utilization", "average_quality_grade")
        ],
    )

    def alert(name: str, limit, text: tuple[str, str], digits: int) -> Column:
        before, after = text
        message = F.concat(F.lit(before), fixed_text(F.col(name), digits), F.lit(after))
        return F.when(F.col(name) < limit, message)

    alerts = F.array_compact(
        F.array(
            alert(V.TARGET, F.col("mean") - V.ALERT_STD_FACTOR * F.col("std"), V.ALERT_PRODUCTION, 2),
            alert("average_quality_grade", V.ALERT_GRADE_LIMIT, V.ALERT_GRADE, 1),
            alert("equipment_utilization", V.ALERT_UTILIZATION_LIMIT, V.ALERT_UTILIZATION, 1),
            F.when(production_trend.select("trend").scalar() == "declining", V.ALERT_TREND),
        )
    )
    enough = F.col("rows") >= V.MIN_ROWS_FOR_STATS
    return newest.select(F.when(enough, alerts).otherwise(F.array().cast("array<string>")).alias("alerts"))


def correlation_matrix(daily: DataFrame, names: Sequence[str] = (*V.BASE_FEATURES, V.TARGET)) -> DataFrame:
    """Pearson correlation of every pair in long form, from one pass over the table.

    Each pair is computed once and serves both of its cells.
    """
    pairs = [(a, b) for number, a in enumerate(names) for b in names[number:]]
    cells = ", ".join(f"struct('{a}' AS a, '{b}' AS b, corr({_value(a)}, {_value(b)}) AS correlation)" for a, b in pairs)
    found = daily.agg(F.expr(f"array({cells})").alias("cells")).select(F.inline("cells"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return found.select(F.explode(both).alias("cell"), "correlation").select(
        F.col("cell.a").alias("row_name"), F.col("cell.b").alias("column_name"), "correlation"
    )


def ranked_correlations(daily: DataFrame, target: str = V.TARGET, features: Sequence[str] = V.BASE_FEATURES) -> DataFrame:
    """Correlation of each feature with the target, strongest first."""
    y = as_double(F.col(target))
    wide = daily.agg(*[F.corr(as_double(F.col(name)), y).alias(name) for name in features])
    rows = [F.struct(F.lit(name).alias("feature"), F.col(name).alias("correlation")) for name in features]
    return wide.select(F.inline(F.array(*rows))).orderBy(F.abs("correlation").desc(), "feature")


def histogram(df: DataFrame, name: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the last bin is closed.

    Bins without rows are kept with a count of 0. A column with a single value gets the
    range one half to either side of it.
    """
    return histograms(df, [name], bins)


def histograms(df: DataFrame, names: Sequence[str], bins: int) -> DataFrame:
    """The :func:`histogram` of every column: one pass for all bounds and one for all counts.

    The second shuffles at most one count per task, column and bin.
    """
    values = df.select(*[as_double(F.col(name)).alias(f"v{i}") for i, name in enumerate(names)])

    def bounds(value: str) -> Column:
        single = F.min(value) == F.max(value)
        return F.struct(
            F.when(single, F.min(value) - 0.5).otherwise(F.min(value)).alias("low"),
            F.when(single, F.max(value) + 0.5).otherwise(F.max(value)).alias("high"),
        )

    edges = values.agg(F.array(*[bounds(f"v{i}") for i in range(len(names))]).alias("edges"))
    edge = edges.scalar()
    long = values.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"v{i}").alias("value")) for i in range(len(names))]))
    ).where("value IS NOT NULL")
    at = edge[F.col("place")]
    position = F.floor((F.col("value") - at["low"]) * float(bins) / (at["high"] - at["low"]))
    counted = long.groupBy("place", F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("count")
    )
    every_bin = (
        df.sparkSession.range(len(names) * bins)
        .select((F.col("id") / bins).cast("int").alias("place"), (F.col("id") % bins).cast("int").alias("bin"))
        .where(at["low"].isNotNull())
    )
    width = (at["high"] - at["low"]) / bins
    return every_bin.join(counted, ["place", "bin"], "left").select(
        F.element_at(F.array(*[F.lit(name) for name in names]), F.col("place") + 1).alias("column_name"),
        "bin",
        (at["low"] + width * F.col("bin")).alias("bin_start"),
        (at["low"] + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def error_metrics(
    predictions: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction"
) -> DataFrame:
    """MSE, RMSE, MAE, R2 and MAPE (percent) per group of predictions.

    The total sum of squares comes from the population variance, so one pass is enough.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    share = F.abs(error) / F.greatest(F.abs(y), F.lit(V.FLOAT_EPSILON))
    squared = F.sum(error * error)
    total = F.var_pop(y) * F.count(y)
    return predictions.groupBy(*by).agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(squared, total)).alias("r2"),
        (F.avg(share) * 100.0).alias("mape"),
    )
