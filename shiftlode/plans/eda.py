"""The data behind the exploratory panels, one DataFrame per panel."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import aggregates as A
from shiftlode.operators import stats


def series(daily: DataFrame) -> DataFrame:
    return daily.select("date", V.TARGET)


def feature_pairs(daily: DataFrame) -> DataFrame:
    """Feature and target values per day, in long form."""
    return daily.unpivot(["date", V.TARGET], V.BASE_FEATURES, "feature", "feature_value")


def feature_histograms(daily: DataFrame, bins: int = V.FEATURE_BINS) -> DataFrame:
    return stats.histograms(daily, V.BASE_FEATURES, bins)


def eda_tables(daily: DataFrame) -> dict[str, DataFrame]:
    return {
        "series": series(daily),
        "target_histogram": stats.histogram(daily, V.TARGET, V.TARGET_BINS),
        "correlation_matrix": stats.correlation_matrix(daily),
        "feature_pairs": feature_pairs(daily),
        "monthly_mean": A.monthly_mean(daily).orderBy("month_end"),
        "feature_histograms": feature_histograms(daily),
        "description": stats.describe_table(daily),
        "ranked_correlations": stats.ranked_correlations(daily),
        "missing_values": daily.agg(
            sum((F.count_if(F.col(name).isNull()) for name in daily.columns), F.lit(0)).alias("missing_values")
        ),
    }
