"""Exact quantiles of large tables by refining bins.

An exact percentile aggregate keeps every distinct value of a column in one buffer. Here a double becomes a
long that sorts as it does, and the values at the wanted ranks are found from the upper bits down: a round counts
the values per bin, where a bin is a run of longs with equal upper bits, and the next round looks only into the bins that hold a
wanted rank. The longs are stored once, each round reads them once, shuffles at most ``BINS`` counts a bin
looked into and task, and leaves one row per column and rank. A bin with a single value ends its search; after six rounds
all bits are known.

NULL and NaN take no part; both zeros are one value. A column without values has NULL quantiles. Repeated values
and hot values are counts, wherever their rows lie.
"""

import struct
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlode.functions.scalars import as_double
from shiftlode.session import settle

# Bits left below the bin in each round: sign and exponent first, then twelve bits at a time.
SHIFTS = (52, 40, 28, 16, 4, 0)
BINS = 1 << 12


def order_key(value: Column) -> Column:
    """A long that sorts as the double: the bits as IEEE 754 stores them, negated below zero. NULL and NaN give NULL."""
    return F.pandas_udf(_order_keys, "long")(value)


def _order_keys(numbers: pd.Series) -> pd.Series:
    doubles = numbers.to_numpy(np.float64)
    bits = np.abs(doubles).view(np.int64)
    return pd.Series(pd.arrays.IntegerArray(np.where(doubles < 0, -bits, bits), np.isnan(doubles)))


def key_value(key: int) -> float:
    """The double of an :func:`order_key`."""
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size


def values_at(df: DataFrame, ranks: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of columns, among the values that are there.

    A rank has to be below the number of values of its column.
    """
    spark = df.sparkSession
    names = [name for name in ranks if len(ranks[name])]
    found: dict[tuple[str, int], float] = {}
    if not names:
        return found
    keys = settle(df.select(*[order_key(as_double(F.col(name))).alias(f"k{number}") for number, name in enumerate(names)]), "keys")
    long = keys.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"k{i}").alias("key")) for i in range(len(names))]))
    ).where("key IS NOT NULL")
    # (column, rank) -> bin of the last round and rank within it
    open_ranks = {(i, rank): (0, rank) for i, name in enumerate(names) for rank in set(ranks[name])}
    above = None
    for shift in SHIFTS:
        bin_above = F.lit(0).cast("long") if above is None else F.shiftright("key", above)
        wanted = {}
        for (column, _), (at, _) in open_ranks.items():
            wanted.setdefault(column, set()).add(at)
        inside = reduce(
            Column.__or__, [(F.col("column") == column) & bin_above.isin(sorted(bins)) for column, bins in wanted.items()]
        )
        counts = long.where(inside).groupBy("column", bin_above.alias("above"), F.shiftright("key", shift).alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        so_far = Window.partitionBy("column", "above").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counts.withColumn("end", F.sum("n").over(so_far))
        # One row per column and open rank.
        asked = spark.createDataFrame(
            [(column, rank, at, left) for (column, rank), (at, left) in open_ranks.items()],
            "column int, rank long, above long, left long",
        )
        hits = placed.join(F.broadcast(asked), ["column", "above"]).where("left < end AND left >= end - n")
        open_ranks = {}
        for hit in hits.select("column", "rank", "bin", (F.col("left") - F.col("end") + F.col("n")).alias("left"), "low", "high").collect():
            if hit["low"] == hit["high"]:
                found[names[hit["column"]], hit["rank"]] = key_value(hit["low"])
            else:
                open_ranks[hit["column"], hit["rank"]] = (hit["bin"], hit["left"])
        if not open_ranks:
            break
        above = shift
    return found


def exact_quantiles(df: DataFrame, names: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row per column: ``column_name``, ``count`` and one column ``q<i>`` per share, interpolated between neighbours.

    Equal to the exact percentile aggregate of Spark.
    """
    names = list(names)
    sizes = df.agg(*[F.count(as_double(F.col(name))).alias(f"n{i}") for i, name in enumerate(names)]).first()
    places = {
        name: [share * (sizes[i] - 1) for share in shares] if sizes[i] else [] for i, name in enumerate(names)
    }
    ranks = {name: sorted({near for place in places[name] for near in (int(place), -int(-place // 1))}) for name in names}
    values = values_at(df, ranks)

    def at(name: str, place: float) -> float:
        low, high = int(place), -int(-place // 1)
        first, last = values[name, low], values[name, high]
        return first if first == last else (high - place) * first + (place - low) * last

    rows = [
        (name, sizes[i], *([at(name, place) for place in places[name]] or [None] * len(shares)))
        for i, name in enumerate(names)
    ]
    fields = ", ".join(f"q{i} double" for i in range(len(shares)))
    return df.sparkSession.createDataFrame(rows, f"column_name string, count long, {fields}")
