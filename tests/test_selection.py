import math
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftlode.operators import selection as S
from shiftlode.operators import stats

SHARES = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)


def bits(value: float) -> int:
    size = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -size if value < 0 else size


def test_keys_are_the_bits_for_every_exponent(spark):
    """Powers of two, their neighbours on both sides and values between, down to the smallest and up to infinity."""
    powers = np.array([math.ldexp(1.0, e) for e in range(-1074, 1024)])
    sizes = np.concatenate([powers, np.nextafter(powers, np.inf), np.nextafter(powers, 0), powers * 1.37, [math.inf]])
    values = np.unique(np.concatenate([sizes, -sizes, [0.0]]))
    rows = spark.createDataFrame(pd.DataFrame({"v": values})).select("v", S.order_key(F.col("v")).alias("key")).collect()
    assert [(r["v"], r["key"]) for r in rows if r["key"] != bits(r["v"])] == []
    assert all(S.key_value(r["key"]) == r["v"] for r in rows)


@pytest.mark.parametrize("kind", ["even", "hot", "wide", "tiny", "one", "repeats"])
def test_quantiles_equal_the_percentile_aggregate(spark, kind):
    rng = np.random.default_rng(5)
    values = {
        "even": rng.uniform(-5, 5, 5000),
        "hot": np.concatenate([np.full(2000, 7.25), rng.normal(0, 1e6, 3000)]),
        "wide": rng.choice([-1, 1], 4000) * np.exp2(rng.uniform(-1070, 1020, 4000)),
        "tiny": 1.0 + np.arange(3000) * 2.0**-52,
        "one": np.array([3.5]),
        "repeats": rng.integers(0, 4, 3000).astype(float),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"a": values})).repartition(5)
    got = S.exact_quantiles(df, ["a"], SHARES).first()
    want = df.select(F.percentile("a", list(SHARES))).first()[0]
    assert [got[f"q{i}"] for i in range(len(SHARES))] == want
    assert got["count"] == len(values)


def test_nulls_nan_zeros_and_empty_columns(spark):
    rows = [(1.0, None, 0.0, 2), (None, None, -0.0, 4), (float("nan"), float("nan"), None, None), (3.0, None, 0.0, 9)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int")
    got = {row["column_name"]: tuple(row)[1:] for row in S.exact_quantiles(df, ["a", "b", "c", "d"], (0.5,)).collect()}
    assert got == {"a": (2, 2.0), "b": (0, None), "c": (3, 0.0), "d": (3, 4.0)}
    assert S.exact_quantiles(df.where("a > 9"), ["a"], (0.5,)).first()["q0"] is None


def test_infinite_values_have_ranks(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,)], "a double")
    assert S.values_at(df, {"a": [0, 1, 2]}) == {("a", 0): -math.inf, ("a", 1): 1.0, ("a", 2): math.inf}


def test_statistics_by_bins_equal_the_exact_ones(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    plain, binned = (
        stats.describe_table(lines, names, by_bins=way).toPandas().set_index("column_name").loc[names] for way in (False, True)
    )
    pd.testing.assert_frame_equal(plain, binned, rtol=1e-12)
    plain, binned = (
        stats.metric_stats(lines, names, by_bins=way).toPandas().set_index("metric").loc[names] for way in (False, True)
    )
    pd.testing.assert_frame_equal(plain, binned, rtol=1e-12)


def test_rows_are_read_once(spark):
    """The values are computed once, however many rounds look at them."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counting(number):
        seen.add(1)
        return number / 7.0

    df = spark.range(5000).select(counting("id").alias("v"))
    assert S.values_at(df, {"v": [0, 1234, 4999]}) == {("v", rank): rank / 7.0 for rank in (0, 1234, 4999)}
    assert seen.value == 5000
