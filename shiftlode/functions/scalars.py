"""Column functions. Each takes columns and returns a column; all run inside codegen.

A missing value never satisfies a comparison and survives clipping, so the functions
use CASE expressions where ``least``/``greatest`` would swallow a NULL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftlode import fixed_values as V


def as_double(value: Column) -> Column:
    """Double with NaN turned into NULL (decimals are averaged as doubles)."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def salt_of(salts: int, *names: str) -> Column:
    """Group number that spreads the rows of a hot key, full copies of a row included.

    The input partition is part of the hash, since copies agree in every column. A task
    that is run again sees the same partition number, so the salt does not change.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *names), F.lit(salts)).cast("int")


def below(value: Column, limit) -> Column:
    return F.coalesce(value < limit, F.lit(False))


def outside(value: Column, low, high) -> Column:
    return F.coalesce((value < low) | (value > high), F.lit(False))


def clamp_negative(value: Column) -> Column:
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def clamp_range(value: Column, low: float, high: float) -> Column:
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def tokens(text: Column) -> Column:
    """The parts between commas, without blanks and quotes around them."""
    return F.transform(F.split(text, ","), lambda part: F.trim(F.btrim(F.trim(part), F.lit("'"))))


def fuel_efficiency(fuel: Column, total: Column) -> Column:
    """Mean fuel per ton; 0 on days without output; NULL where fuel is unknown."""
    return F.when(total > 0, fuel / total).otherwise(F.lit(0.0))


def weather_impact_score(temperature: Column, rain: Column) -> Column:
    """100 less points for rain above the limit and for distance from 25 degrees."""
    wet = F.when(rain > V.HIGH_RAIN_MM, (rain - V.HIGH_RAIN_MM) * V.RAIN_POINTS_PER_MM)
    uneasy = F.abs(temperature - V.COMFORT_TEMPERATURE) * V.TEMPERATURE_POINTS_PER_DEGREE
    score = F.lit(V.IMPACT_FULL_SCORE) - wet.otherwise(F.lit(0.0)) - uneasy
    return clamp_range(score, 0.0, V.IMPACT_FULL_SCORE)


def high_precipitation(rain: Column) -> Column:
    return F.when(rain > V.HIGH_RAIN_MM, 1).otherwise(0)


def source_kind(day: Column, as_of: Column) -> Column:
    """Which weather feed serves a day."""
    return F.when(day <= as_of, "historical").otherwise("forecast")


def days_inclusive(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def count_flag(kind: str, count: Column) -> Column:
    """``kind_N`` when N rows are affected, else NULL (to be dropped by array_compact)."""
    return F.when(count > 0, F.concat(F.lit(f"{kind}_"), count.cast("string")))


def present(*items: Column) -> Column:
    """Array of the non-NULL items."""
    return F.array_compact(F.array(*[item.cast("string") for item in items]))


def health_bucket(score: Column) -> Column:
    (first_limit, first_name), *others = V.HEALTH_BUCKETS
    bucket = F.when(score >= first_limit, first_name)
    for limit, name in others:
        bucket = bucket.when(score >= limit, name)
    return bucket.otherwise(V.HEALTH_OTHERWISE)


def severity(value: Column, mean: Column, std: Column) -> Column:
    far = F.abs(value - mean) > V.HIGH_SEVERITY_STD * std
    return F.when(far, "high").otherwise("medium")


def fixed_text(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded from the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form half up, so 0.125 would become
    0.13 and 1.005 (a little less in binary) 1.01. Splitting the double into two halves
    makes ``value * 10^digits`` exact, so the rest tells on which side the value lies. Its half is taken off before the
    low part is added, which may be less than the last bit of a half (0.05 to one decimal).
    """
    scale = float(10**digits)
    wide = value * F.lit(134217729.0)
    high = wide - (wide - value)
    low = value - high
    whole = F.floor(value * scale).cast("double")
    above = (high * scale - whole - 0.5) + low * scale
    up = F.when(above > 0, 1.0).when(above < 0, 0.0).otherwise(F.pmod(whole, F.lit(2.0)))
    rounded = (whole + up) / scale
    minus_zero = (rounded == 0) & (value < 0)
    text = F.when(minus_zero, f"-{0:.{digits}f}").otherwise(F.format_string(f"%.{digits}f", rounded))
    return F.when(value.isNotNull(), text)


def range_text(low: Column, high: Column) -> Column:
    return F.concat(fixed_text(low, 2), F.lit(" - "), fixed_text(high, 2))


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar parts; the week is the ISO week and Monday is day 0."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "day_of_week": F.weekday(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def interactions() -> dict[str, Column]:
    grade, used = F.col("average_quality_grade"), F.col("equipment_utilization")
    return {
        "quality_utilization": grade * used,
        "efficiency_weather": F.col("fuel_efficiency") * F.col("weather_impact_score"),
    }


def polynomials(names=("equipment_utilization", "average_quality_grade")) -> dict[str, Column]:
    columns = {}
    for name in names:
        columns[f"{name}_squared"] = F.col(name) * F.col(name)
        columns[f"{name}_log"] = F.log1p(F.col(name))
    return columns
