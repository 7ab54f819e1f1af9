"""Quality rules and an isolation forest on their statistics.

Every text gives a few counts (words, symbols, repeated lines, repeated word triples, capitals,
exclamation marks). Hard rules come first: too few words or mostly repeated triples fail.
An isolation forest judges the rest: trees split the labelled rows at random values of random
rates until rows are alone or ``LEVELS`` is reached; anomalous rows get alone after few splits. The score is
``2 ** (-mean path / expected path)``. Rates are taken in coarse steps, as the limits of rules are, so
that the small differences of ordinary texts isolate nothing. The threshold is calibrated on
labelled rows: the lowest cut that loses at most ``LOSS`` of the good ones.

Every labelled row takes part in every tree and in the threshold. Rows with equal rates are one row with a number, in a stored table.
All trees grow by one level at a time: a pass over that table gives size and ranges of every node, one row per node comes to the
driver. Isolation needs anomalies to be rare, so the bad rows weigh together as one good row: they widen the ranges that are split,
and a node of bad rows alone is closed. The threshold is found by counting scores in bins and looking again into the bin that holds the wanted rank. The model is a few
arrays of bounded size. Counts and scores take one pass over the texts each time; texts do not move.

Defined cases: a null or empty text has zero counts and fails the hard rule; repeated rows get equal
verdicts; without labelled rows of both kinds nothing but the hard rules rejects; an
empty table gives an empty table; other columns are ignored by :func:`judge` and kept by :func:`kept_rows`.
"""

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import SPACE, arrow_types, to_batch, values, words_of
from shiftlode.session import settle

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50  # percent of the words
TREES, LEVELS = 200, 8
LOSS = 0.001
SEED = 7
BITS = 12  # of a score that a round of the search for the threshold settles
ROUNDS = 5
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks"]


def rule_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    data = text.encode("utf-8", "surrogatepass")
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(data) - len(data.translate(None, CAPITALS)),
        text.count("!"),
    )


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of three words that the text has at least twice."""
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    number = np.fromiter(map(seen.setdefault, words, count()), np.int64, len(words))
    code = number[: len(words) - window + 1]
    for shift in range(1, window):
        # Numbers stay below the square of the length.
        code = np.unique(code, return_inverse=True)[1] * len(words) + number[shift : len(words) - window + 1 + shift]
    _, place, times = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.nonzero(times[place] > 1)[0]
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def rates(counts: np.ndarray) -> np.ndarray:
    """Counts (rows x 7) to the rates that the forest sees, in coarse steps; sizes of texts are left out."""
    words, chars, symbols, _, repeat, capitals, marks = counts.T.astype(np.float64)
    word, char = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack(
        [
            np.round(symbols / char, 2),
            np.maximum(repeat / word - 0.25, 0),  # up to a quarter is ordinary
            np.round(capitals / char, 1),
            np.round(marks / word, 1),
        ],
        axis=1,
    )


def node_ranges(forest: "Forest", rows: np.ndarray, numbers: np.ndarray, level: int) -> pd.DataFrame:
    """Sizes (per column of ``numbers``) and ranges of the nodes of a level that are not closed."""
    found = []
    for tree in range(len(forest.feature)):
        node = forest.place(tree, rows, level)
        here = np.nonzero(node >= (1 << level) - 1)[0]
        if not len(here):
            continue
        order = here[np.argsort(node[here], kind="stable")]
        nodes, first = np.unique(node[order], return_index=True)
        parts = [np.add.reduceat(numbers[order], first, axis=0)]
        parts += [step.reduceat(rows[order], first, axis=0) for step in (np.minimum, np.maximum)]
        found.append(np.column_stack([np.full(len(nodes), tree), nodes, *parts]))
    names = ["tree", "node", *[f"n{i}" for i in range(numbers.shape[1])]]
    names += [f"{side}{i}" for side in ("low", "high") for i in range(rows.shape[1])]
    return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, len(names))), columns=names)


class Forest:
    """Trees as arrays: feature (-1: leaf), split value, path length at a leaf; children 2i+1 and 2i+2.

    ``ranges(forest, level)`` gives the :func:`node_ranges` over all rows, wherever they lie; ``weights`` are those of the numbers.
    """

    def __init__(self, rows: np.ndarray | None = None, trees: int = TREES, levels: int = LEVELS, seed: int = SEED, ranges: Callable | None = None, weights: tuple = (1.0,)):
        if ranges is None:
            numbers = np.ones((len(rows), 1))
            ranges = lambda forest, level: node_ranges(forest, rows, numbers, level)
        nodes = (2 << levels) - 1
        self.feature = np.full((trees, nodes), -1, np.int16)
        self.value = np.zeros((trees, nodes))
        self.path = np.zeros((trees, nodes))
        self.expected, self.depth = 0.0, 0
        source = np.random.default_rng(seed)
        for level in range(levels + 1):
            found = ranges(self, level).sort_values(["tree", "node"])
            if not len(found):
                break
            size = found[[f"n{i}" for i in range(len(weights))]].to_numpy() @ np.array(weights)
            low, high = (found.filter(regex=f"^{side}").to_numpy() for side in ("low", "high"))
            if level == 0:
                self.expected = expected_path(size[0])
            for tree, node, n, least, most in zip(found["tree"].astype(int), found["node"].astype(int), size, low, high):
                varied = np.nonzero(most > least)[0]
                if level == levels or n <= 1 or not len(varied):
                    self.path[tree, node] = level + expected_path(n)
                    continue
                feature = source.choice(varied)
                self.feature[tree, node], self.value[tree, node] = feature, source.uniform(least[feature], most[feature])
                self.depth = level + 1

    def place(self, tree: int, rows: np.ndarray, levels: int) -> np.ndarray:
        """The nodes of rows after some levels; rows in leaves stay there."""
        feature, value = self.feature[tree], self.value[tree]
        node, every = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for _ in range(levels):
            at = feature[node]
            right = rows[every, at] > value[node]
            node = np.where(at < 0, node, 2 * node + 1 + right)
        return node

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; anomalous rows are near 1."""
        total = np.zeros(len(rows))
        for tree, path in enumerate(self.path):
            total += path[self.place(tree, rows, self.depth)]
        return 2.0 ** (-total / len(self.feature) / max(self.expected, 1e-9))


def expected_path(size: float) -> float:
    """Mean path of an unsuccessful search among ``size`` rows."""
    if size <= 1:
        return 0.0
    return 2.0 * (np.log(size - 1) + 0.5772156649015329) - 2.0 * (size - 1) / size if size > 2 else 1.0


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT * counts[:, 0])


class Verdict:
    """Forest and threshold; judges rows of counts."""

    def __init__(self, forest: Forest | None, threshold: float):
        self.forest, self.threshold = forest, threshold

    def __call__(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        failed = base_failed(counts)
        score = self.forest.score(rates(counts)) if self.forest else np.zeros(len(counts))
        return failed, score, ~failed & (score <= self.threshold)


RATES = ["r0", "r1", "r2", "r3"]


def counted(labelled: DataFrame) -> DataFrame:
    """Rates that labelled rows have, with the number of good and bad rows at each; rows that the hard rules reject are left out."""
    good = F.col("_good") > 0
    table = labelled.filter("NOT failed").groupBy(*RATES).agg(F.count_if(good).alias("n0"), F.count_if(~good).alias("n1"))
    return settle(table, "rates")


def _rated(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, hash of the text, hard rule and rates of every row."""
    schema = "_key long, _hash long, failed boolean, " + ", ".join(f"{name} double" for name in RATES)
    names, types = [field.split()[0] for field in schema.split(", ")], arrow_types(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([rule_counts(value) for value in values(batch.column(2))], np.int64).reshape(-1, len(COUNTS))
            results = [batch.column(0), batch.column(1), base_failed(counts), *rates(counts).T]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind) for part, kind in zip(results, types)], names=names)

    return df.select(F.col(key).cast("long"), F.xxhash64(text), F.col(text)).mapInArrow(run, schema)


def _numbered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rates and numbers of some rows of :func:`counted`."""
    rows = batch.to_pandas()
    return rows[RATES].to_numpy(np.float64), rows[["n0", "n1"]].to_numpy(np.int64)


def _ranges(table: DataFrame) -> Callable[[Forest, int], pd.DataFrame]:
    """The :func:`node_ranges` of a table of rates. At most one row per tree and node of a level comes to the driver."""
    bounds = [f"{side}{i}" for side in ("low", "high") for i in range(len(RATES))]
    schema = "tree int, node long, n0 long, n1 long, " + ", ".join(f"{name} double" for name in bounds)

    def ranges(forest: Forest, level: int) -> pd.DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = node_ranges(forest, *_numbered(batch), level)
                columns = [pa.array(found[field.split()[0]].to_numpy().astype(kind.to_pandas_dtype()), kind) for field, kind in zip(schema.split(", "), arrow_types(schema))]
                yield pa.RecordBatch.from_arrays(columns, names=list(found.columns))

        sides = [F.min(name).alias(name) if name.startswith("low") else F.max(name).alias(name) for name in bounds]
        return table.mapInArrow(run, schema).groupBy("tree", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), *sides).toPandas()

    return ranges


def _threshold(table: DataFrame, forest: Forest, good: int) -> float:
    """The largest score that is kept: of the cuts that lose at most ``LOSS`` of the good rows, the lowest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers = _numbered(batch)
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(rows)), pa.array(numbers[:, 0])], names=["score", "n"])

    scores = settle(table.filter("n0 > 0").mapInArrow(run, "score double, n long").groupBy("score").agg(F.sum("n").alias("n")), "scores")
    rank, scale = math.ceil((good - 1) * (1 - LOSS)), 1
    for _ in range(ROUNDS):
        # Scores lie between 0 and 1: products with powers of two are exact. At most 2 ** BITS bins and one more come to the driver.
        scale <<= BITS
        bins = scores.groupBy(F.floor(F.col("score") * F.lit(float(scale))).alias("bin")).agg(F.sum("n").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for row in bins.orderBy("bin").collect():
            if rank < row.n:
                break
            rank -= row.n
        if row.low == row.high:
            break
        scores = scores.filter(F.col("score").between(row.low, row.high))
    return row.high


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> Verdict:
    """Forest and threshold from all labelled rows (1 good, 0 bad)."""
    marked = labels.select(F.col(key).cast("long").alias("_key"), F.col(quality).alias("_good")).filter("_key IS NOT NULL AND _good IS NOT NULL")
    marked = marked.groupBy("_key").agg(F.min("_good").alias("_good"))
    # One row per id: of several texts with a labelled id the one with the least hash counts.
    least = _rated(df, key, text).groupBy("_key").agg(F.min(F.struct("_hash", "failed", *RATES)).alias("_least"))
    table = counted(least.join(marked, "_key").select("_least.*", "_good"))
    good, bad = (size or 0 for size in table.agg(F.sum("n0"), F.sum("n1")).first())
    if not good or not bad:
        return Verdict(None, float("inf"))
    forest = Forest(ranges=_ranges(table), weights=(1.0, 1.0 / bad))
    return Verdict(forest, _threshold(table, forest, good))


SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS) + ", base_failed boolean, score double, kept boolean"


def judge(df: DataFrame, verdict: Verdict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, hard rule, anomaly score and verdict of every row."""
    names, types = [field.split()[0] for field in SCHEMA.split(", ")], arrow_types(SCHEMA)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([rule_counts(value) for value in values(batch.column(1))], np.int64).reshape(-1, len(COUNTS))
            results = [a.tolist() for a in verdict(counts)]
            rows = list(zip(batch.column(0).to_pylist(), *counts.T.tolist(), *results))
            yield to_batch(rows, names, types)

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def kept_rows(df: DataFrame, verdict: Verdict, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    return df.filter(_keeper(verdict)(F.col(text)))


def _keeper(verdict: Verdict) -> Callable:
    @F.pandas_udf("boolean")
    def keeps(texts: pd.Series) -> pd.Series:
        counts = np.array([rule_counts(value) for value in texts], np.int64).reshape(-1, len(COUNTS))
        return pd.Series(verdict(counts)[2])

    return keeps
