"""Row counts, means and products of deviations of several columns, taken per block of rows in one pass.

Moments of two sets of rows add up to those of both, so blocks serve everything that is linear in the
rows: standard deviations, correlations, and least squares with any penalty over any run of blocks, errors
on other blocks included. Products are taken around the mean of their own rows and corrected when sets are put
together, so large means cost no digits.

Tasks multiply matrices batch by batch and give one row per block; these are merged in two steps, so no
task gets more than its share of them. The number of blocks and columns is for the caller to bound: a task holds
``columns ** 2`` numbers per block. Rows with a missing value (NULL or NaN) in any of the columns, or without a
block, take no part.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlode.functions.scalars import as_double

STATE = "part int, block long, rows long, means array<double>, products array<double>"
MERGERS = 64
STATE_COLUMNS = ["part", "block", "rows", "means", "products"]
SMALLEST_SHARE = 1e-12
ROUNDING = 1e-13


@dataclass(frozen=True)
class Moments:
    """``products[i, j]`` is the sum of (x_i - mean_i) (x_j - mean_j)."""

    names: tuple[str, ...]
    rows: int
    means: np.ndarray
    products: np.ndarray

    @classmethod
    def none(cls, names: Sequence[str]) -> "Moments":
        return cls(tuple(names), 0, np.zeros(len(names)), np.zeros((len(names), len(names))))

    @classmethod
    def of(cls, names: Sequence[str], x: np.ndarray) -> "Moments":
        if not len(x):
            return cls.none(names)
        means = x.mean(axis=0)
        rest = x - means
        return cls(tuple(names), len(x), means, rest.T @ rest)

    def __add__(self, other: "Moments") -> "Moments":
        if not self.rows or not other.rows:
            return other if not self.rows else self
        rows = self.rows + other.rows
        apart = other.means - self.means
        products = self.products + other.products + np.outer(apart, apart) * (self.rows * other.rows / rows)
        return Moments(self.names, rows, self.means + apart * (other.rows / rows), products)

    def std(self) -> np.ndarray:
        """Population standard deviations; 0 where a column differs from its mean by rounding only."""
        found = np.sqrt(np.diag(self.products) / max(self.rows, 1))
        return np.where(found > ROUNDING * np.abs(self.means), found, 0.0)

    def correlations(self) -> np.ndarray:
        """Pearson correlations; NaN beside a constant column."""
        size = self.std() * np.sqrt(self.rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = self.products / np.outer(size, size)
        return np.where(np.isfinite(found), np.clip(found, -1.0, 1.0), np.nan)

    def ridge(self, alpha: float, scale: np.ndarray) -> np.ndarray:
        """Coefficients of all columns but the last, which is the target, for columns divided by ``scale``.

        They minimise the sum of squares plus ``alpha`` times their squared length; with no penalty the shortest of
        all solutions. A scale of 0 (a constant column) gives the coefficient 0.
        """
        unit = np.divide(1.0, scale, out=np.zeros(len(scale)), where=scale > 0)
        values, vectors = np.linalg.eigh(self.products[:-1, :-1] * np.outer(unit, unit))
        aim = vectors.T @ (self.products[:-1, -1] * unit)
        free = values > SMALLEST_SHARE * max(values.max(initial=0.0), 0.0)
        weights = np.divide(aim, values + alpha, out=np.zeros(len(aim)), where=free | (alpha > 0))
        return (vectors @ weights) * unit

    def squared_error(self, coefficients: np.ndarray, fitted: "Moments") -> float:
        """Mean squared error on these rows of coefficients that were fitted on others."""
        if not self.rows:
            return float("nan")
        direction = np.append(-coefficients, 1.0)
        spread = max(direction @ self.products @ direction, 0.0)
        return float(spread / self.rows + (direction @ (self.means - fitted.means)) ** 2)


def _packed(block: int, part: int, found: Moments) -> dict:
    upper = found.products[np.triu_indices(len(found.names))]
    return {"part": part, "block": block, "rows": found.rows, "means": found.means.tolist(), "products": upper.tolist()}


def _unpacked(names: Sequence[str], rows: int, means: Sequence[float], upper: Sequence[float]) -> Moments:
    products = np.zeros((len(names), len(names)))
    products[np.triu_indices(len(names))] = upper
    return Moments(tuple(names), int(rows), np.asarray(means, float), products + np.triu(products, 1).T)


def block_moments(df: DataFrame, names: Sequence[str], block: Column | None = None) -> DataFrame:
    """One row per block with its moments, as ``part, block, rows, means, products`` (upper triangle)."""
    names = list(names)
    wide = df.select(
        (F.lit(0) if block is None else block).cast("long").alias("block"),
        *[as_double(F.col(name)).alias(f"x{number}") for number, name in enumerate(names)],
    ).dropna("any")

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, blocks = TaskContext.get().partitionId() % MERGERS, {}
        for batch in batches:
            for key, rows in batch.groupby("block"):
                here = Moments.of(names, rows.iloc[:, 1:].to_numpy(float))
                blocks[key] = blocks.get(key, Moments.none(names)) + here
        yield pd.DataFrame([_packed(key, part, found) for key, found in blocks.items()], columns=STATE_COLUMNS)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        total = Moments.none(names)
        for row in rows.itertuples():
            total = total + _unpacked(names, row.rows, row.means, row.products)
        return pd.DataFrame([_packed(rows["block"].iloc[0], rows["part"].iloc[0], total)])

    states = wide.mapInPandas(taken, STATE)
    return states.groupBy("block", "part").applyInPandas(merged, STATE).groupBy("block").applyInPandas(merged, STATE)


def collect_moments(df: DataFrame, names: Sequence[str], block: Column | None = None) -> dict[int, Moments]:
    """The moments by block, on the driver: a few numbers per block and pair of columns."""
    found = block_moments(df, names, block).collect()
    return {row["block"]: _unpacked(names, row["rows"], row["means"], row["products"]) for row in found}


def total(parts: Sequence[Moments], names: Sequence[str]) -> Moments:
    return sum(parts, Moments.none(names))


def correlation_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in long form, over the rows in which all columns have values.

    :func:`shiftlode.operators.stats.correlation_matrix` has one aggregate per pair, which suits a few columns
    and takes each pair over all rows that have both; this one multiplies matrices and suits dozens of columns.
    """
    matrix = total(list(collect_moments(df, names).values()), names).correlations()
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "row_name string, column_name string, correlation double")
