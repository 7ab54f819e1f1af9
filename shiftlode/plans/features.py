"""Forecast features: lags, rolling statistics, calendar parts, products, weather."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.functions import scalars as S
from shiftlode.operators.ordered import over_previous_rows, with_row_index


def lag_columns(window: WindowSpec, target: str = V.TARGET, lags: Sequence[int] = V.LAGS) -> dict[str, Column]:
    return {f"{target}_lag_{k}": F.lag(target, k).over(window) for k in lags}


def rolling_columns(
    window: WindowSpec,
    target: str = V.TARGET,
    sizes: Sequence[int] = V.ROLLING_WINDOWS,
    include_current: bool = True,
) -> dict[str, Column]:
    """Mean and sample std over n rows; NULL unless all n values are there."""
    columns = {}
    for n in sizes:
        rows = window.rowsBetween(-(n - 1), 0) if include_current else window.rowsBetween(-n, -1)
        full = F.count(target).over(rows) == n
        columns[f"{target}_rolling_mean_{n}"] = F.when(full, F.avg(target).over(rows))
        columns[f"{target}_rolling_std_{n}"] = F.when(full, F.stddev_samp(target).over(rows))
    return columns


def lag_features(indexed: DataFrame, entity: Sequence[str] = (), target: str = V.TARGET) -> DataFrame:
    return over_previous_rows(indexed, lambda w: lag_columns(w, target), max(V.LAGS), entity)


def rolling_features(
    indexed: DataFrame, entity: Sequence[str] = (), target: str = V.TARGET, include_current: bool = True
) -> DataFrame:
    return over_previous_rows(
        indexed,
        lambda w: rolling_columns(w, target, include_current=include_current),
        max(V.ROLLING_WINDOWS),
        entity,
    )


def with_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(S.date_parts(F.col("date")))


def with_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(S.interactions())


def with_polynomials(df: DataFrame) -> DataFrame:
    return df.withColumns(S.polynomials())


def with_temp_deviation(df: DataFrame) -> DataFrame:
    """Distance from the mean temperature of all days of ``df``."""
    mean = df.agg(F.avg("temperature_mean")).scalar()
    return df.withColumn("temp_deviation", F.abs(F.col("temperature_mean") - mean))


def with_high_precipitation(df: DataFrame) -> DataFrame:
    return df.withColumn("high_precipitation", S.high_precipitation(F.col("precipitation_sum")))


def feature_names(include_current: bool = True) -> list[str]:
    """The feature columns in order. Without the current day, the two columns computed
    from the target of the same day (fuel per ton and its product) are left out."""
    return [name for name in V.FEATURE_NAMES if include_current or name not in V.SAME_DAY_FEATURES]


def feature_table(daily: DataFrame, include_current: bool = True) -> DataFrame:
    """date, target and all features; days without a full history are dropped last.

    The position and the mean temperature are taken over all days, before the drop.
    ``include_current=False`` gives rolling windows that end the day before.
    """
    days = daily.select("date", V.TARGET, *V.BASE_FEATURES, "temperature_mean", "precipitation_sum")
    windowed = over_previous_rows(
        with_row_index(days),
        lambda w: {**lag_columns(w), **rolling_columns(w, include_current=include_current)},
        max(*V.LAGS, *V.ROLLING_WINDOWS),
    )
    mean_temperature = days.agg(F.avg("temperature_mean")).scalar()
    full = with_high_precipitation(with_polynomials(with_interactions(with_date_parts(windowed)))).withColumn(
        "temp_deviation", F.abs(F.col("temperature_mean") - mean_temperature)
    )
    return full.select("date", V.TARGET, *feature_names(include_current)).dropna("any")


def removed_rows(daily: DataFrame, features: DataFrame) -> DataFrame:
    """One row: days before, days kept, days dropped for missing history or values."""
    return daily.agg(F.count("*").alias("days")).select(
        "days", features.agg(F.count("*")).scalar().alias("kept")
    ).withColumn("removed", F.col("days") - F.col("kept"))


def time_split(features: DataFrame, test_share: float = V.TEST_SHARE) -> DataFrame:
    """Mark the first rows as train and the last share as test, in date order.

    ``split_index`` is the position among the kept rows.
    """
    rows = features.agg(F.count("*")).scalar()
    cut = F.floor(rows * (1.0 - test_share))
    indexed = with_row_index(features, name="split_index")
    return indexed.withColumn("split", F.when(F.col("split_index") < cut, "train").otherwise("test"))


def fold_bounds(train: DataFrame, folds: int = V.FOLDS) -> DataFrame:
    """Per fold: the first test row and the first row after it, over the train rows.

    Each fold tests on the next block of rows and trains on all rows before it.
    """
    sized = train.agg(F.count("*").alias("rows")).withColumn("size", F.floor(F.col("rows") / (folds + 1)))
    fold = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    return sized.withColumn("fold", fold).select(
        "fold",
        (F.col("rows") - (folds - F.col("fold")) * F.col("size")).alias("test_start"),
        (F.col("rows") - (folds - 1 - F.col("fold")) * F.col("size")).alias("test_end"),
    )


def fold_block(train: DataFrame, folds: int = V.FOLDS, index: str = "split_index") -> Column:
    """The fold in which a train row is tested, -1 for the rows before the first test block.

    Each row belongs to at most one test block, so the blocks come from arithmetic on the position.
    """
    rows = train.agg(F.count("*")).scalar()
    size = F.floor(rows / (folds + 1))
    first = rows - folds * size
    return F.when(F.col(index) >= first, F.floor((F.col(index) - first) / size)).otherwise(F.lit(-1))


def expanding_folds(train: DataFrame, folds: int = V.FOLDS, index: str = "split_index") -> DataFrame:
    """Every train row with the folds it is used in: its own test fold, if any, and as
    training row in all later folds. No join is needed."""
    own = fold_block(train, folds, index)
    fold = F.sequence(F.greatest(own, F.lit(0)).cast("int"), F.lit(folds - 1))
    return (
        train.withColumn("_own", own)
        .withColumn("fold", F.explode(fold))
        .withColumn("role", F.when(F.col("fold") == F.col("_own"), "test").otherwise("train"))
        .drop("_own")
    )
