"""Forests and boosted trees over daily tables: many fits at once, tree counts judged from one fit.

A daily table is small (one row per day) but a search fits hundreds of models to it, so Spark spreads the fits, not the
rows: a job is one fold and one setting (for forests also a block of trees), and every task gets the table as arrays of checked size.

**Staged evaluation.** A forest of 300 trees holds those of 100 and 200, and a boosted model those of fewer rounds. Settings that
differ only in the number of trees are one fit; its trees between two asked numbers give a part of the
prediction of every held-out row, and the parts up to a number add up to the prediction of that model. The sums,
errors per fold and their means are Spark aggregations.

Trees are grown level by level over values sorted once; all splits between different values are tried, the
best reduction of the squared error wins, ties (up to rounding) go to the first feature and the lowest value. Every tree draws its rows from a generator
seeded by its number, so results do not depend on the number of tasks.

Missing values are not allowed in features or target. A table without rows, or with fewer than ``folds + 1``, has no folds and raises ValueError.
"""

import itertools
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.plans.features import fold_bounds
from shiftlode.session import settle

MOST_ROWS = 100_000  # days; about 25 MB of 32 features
BLOCK = 25  # trees of a forest that one task grows
MODELS = ("Random_Forest", "Gradient_Boosting")
LEAF = -1
TIE = 1e-9  # relative; smaller differences of gains are rounding


class Tree:
    """Arrays by node: feature (``LEAF``: none), highest value that goes left, number of the left child (the right one follows), mean of the rows."""

    def __init__(self, feature: np.ndarray, limit: np.ndarray, left: np.ndarray, value: np.ndarray):
        self.feature, self.limit, self.left, self.value = feature, limit, left, value

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[node[rows]] != LEAF]
            at = node[rows]
            node[rows] = self.left[at] + (x[rows, self.feature[at]] > self.limit[at])
        return self.value[node]


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, order: np.ndarray, depth: int | None, leaf: int, split: int) -> Tree:
    """A tree over the rows in ``order`` (features x rows, each sorted by value); limits count rows, sums use their weights."""
    features, limits, lefts, means = [], [], [], []
    rows = order[0]
    shift = np.average(y[rows], weights=weight[rows]) if len(rows) else 0.0
    y = y - shift  # sums near 0 keep their digits
    node = np.zeros(len(x), np.int64)  # of each row, among the nodes of the level
    made, level = 1, 0
    every = np.arange(order.shape[0])[:, None]
    while order.shape[1]:
        at = node[order[0]]
        first = np.nonzero(np.diff(at, prepend=-1))[0]
        size = np.diff(first, append=len(at))
        mass = np.cumsum(weight[order], axis=1)
        total = np.cumsum(weight[order] * y[order], axis=1)
        last = first + size - 1
        # Sums of the rows of the node up to each place, per feature.
        mass -= np.where(first > 0, mass[:, first - 1], 0)[:, at]
        total -= np.where(first > 0, total[:, first - 1], 0)[:, at]
        all_mass, all_total = mass[0, last], total[0, last]
        chosen, place = np.full(len(first), LEAF), np.zeros(len(first), np.int64)
        if depth is None or level < depth:
            value = x[order, every]
            left = np.arange(len(at)) - first[at] + 1
            able = (left >= leaf) & (size[at] - left >= max(leaf, 1)) & (size[at] >= split)
            able = able & np.append(value[:, 1:] > value[:, :-1], np.zeros((len(value), 1), bool), axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(able, total**2 / mass + (all_total[at] - total) ** 2 / (all_mass[at] - mass), -np.inf)
            best = np.maximum.reduceat(score, first, axis=1)
            top = best.max(axis=0)
            near = top - TIE * np.maximum(np.abs(top), TIE)
            winner = (best >= near).argmax(axis=0)
            best = best[winner, np.arange(len(first))]
            base = all_total**2 / all_mass
            better = best > base + TIE * np.maximum(np.abs(best), TIE)
            here = score[winner[at], np.arange(len(at))] >= near[at]
            place = np.minimum.reduceat(np.where(here, np.arange(len(at)), len(at) - 1), first)
            chosen = np.where(better, winner, LEAF)
        goes_on = chosen != LEAF
        rank = np.cumsum(goes_on) - 1
        limit = np.zeros(len(first))
        if goes_on.any():
            low, high = value[chosen[goes_on], place[goes_on]], value[chosen[goes_on], place[goes_on] + 1]
            middle = low + (high - low) / 2
            limit[goes_on] = np.where(middle < high, middle, low)
        features.append(chosen), limits.append(limit), means.append(all_total / all_mass + shift)
        lefts.append(np.where(goes_on, made + 2 * rank, 0))
        made += 2 * int(goes_on.sum())
        order = order[goes_on[node[order]]].reshape(len(order), -1)
        rows = order[0]
        old = node[rows]
        node[rows] = 2 * rank[old] + (x[rows, chosen[old]] > limit[old])
        order = np.take_along_axis(order, np.argsort(node[order], axis=1, kind="stable"), axis=1)
        level += 1
    return Tree(*[np.concatenate(parts) for parts in (features, limits, lefts, means)])


class Table:
    """Features, target and position of the rows of one fit, sorted once per feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x, y
        self.order = np.argsort(x, axis=0, kind="stable").T

    def tree(self, y: np.ndarray, weight: np.ndarray, params: dict) -> Tree:
        order = self.order[weight[self.order] > 0].reshape(len(self.order), -1)
        return grow(self.x, y, weight, order, params.get("max_depth"), params.get("min_samples_leaf", 1), params.get("min_samples_split", 2))


def forest_trees(table: Table, params: dict, start: int, stop: int) -> Iterator[Tree]:
    """Trees ``start`` to ``stop`` of a forest, each over as many rows as there are, drawn with replacement."""
    for number in range(start, stop):
        drawn = np.random.default_rng([V.SEED, number]).integers(0, len(table.y), len(table.y))
        yield table.tree(table.y, np.bincount(drawn, minlength=len(table.y)).astype(float), params)


def boosted_trees(table: Table, params: dict, stop: int) -> Iterator[Tree]:
    """Trees over what the sum of those before leaves, each from a share of the rows."""
    rate, share = params.get("learning_rate", 0.1), params.get("subsample", 1.0)
    rest = table.y - table.y.mean()
    for number in range(stop):
        weight = np.ones(len(rest))
        if share < 1:
            out = np.random.default_rng([V.SEED, number]).permutation(len(rest))[max(1, int(share * len(rest))) :]
            weight[out] = 0
        tree = table.tree(rest, weight, params)
        rest = rest - rate * tree.predict(table.x)
        yield tree


def trees_of(model: str, table: Table, params: dict, start: int, stop: int) -> Iterator[Tree]:
    return forest_trees(table, params, start, stop) if model == "Random_Forest" else boosted_trees(table, params, stop)


@dataclass
class TreeModel:
    """Trees as a table (tree, node, feature, limit, left, value) and how their values make a prediction."""

    model: str
    names: list[str]
    offset: float
    factor: float
    nodes: DataFrame
    _trees: list[Tree] = field(default_factory=list)

    def trees(self) -> list[Tree]:
        """The nodes as arrays; their number is at most twice the rows of the training table times the trees."""
        if not self._trees:
            rows = self.nodes.toArrow().to_pandas().sort_values(["tree", "node"])
            for _, part in rows.groupby("tree"):
                self._trees.append(Tree(*[part[name].to_numpy() for name in ("feature", "limit", "left", "value")]))
        return self._trees

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.offset + self.factor * sum((tree.predict(x) for tree in self.trees()), np.zeros(len(x)))

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``prediction``; rows do not move."""
        held = rows.sparkSession.sparkContext.broadcast((self.trees(), self.offset, self.factor))

        @F.pandas_udf("double")
        def predicted(features: pd.Series) -> pd.Series:
            trees, offset, factor = held.value
            x = np.array(features.tolist(), float).reshape(len(features), -1)
            return pd.Series(offset + factor * sum((tree.predict(x) for tree in trees), np.zeros(len(x))))

        return rows.withColumn("prediction", predicted(F.array(*[F.col(name).cast("double") for name in self.names])))

    def save(self, path: str) -> None:
        settings = {"model": self.model, "names": self.names, "offset": self.offset, "factor": self.factor}
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(settings),)], "value string").write.mode("overwrite").text(f"{path}/settings")


def load_trees(spark: SparkSession, path: str) -> TreeModel | None:
    """A stored tree model, or None if there is none at ``path``."""
    try:
        nodes = spark.read.parquet(f"{path}/nodes")
    except AnalysisException:
        return None
    return TreeModel(**json.loads(spark.read.text(f"{path}/settings").first()[0]), nodes=nodes)


@dataclass
class Search:
    """Result of :func:`search`: the best setting fitted on all rows, and mean errors per setting."""

    model: str
    params: dict
    fitted: TreeModel
    cv_mse: float
    scores: list[tuple[dict, float]]
    fold_scores: list[tuple[dict, int, float]]
    fits: int  # models grown for the scores; settings that differ in the number of trees share one


def _arrays(df: DataFrame, names: list[str], label: str, index: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and target sorted by position; refuses tables that are no daily tables."""
    if df.count() > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows: use models.tune, which spreads the rows of a fit")
    columns = [F.col(name).cast("double").alias(f"c{i}") for i, name in enumerate([label, *names])]
    rows = df.select(F.col(index).alias("_at"), *columns).toArrow().to_pandas().sort_values("_at").drop(columns="_at").to_numpy(float)
    if np.isnan(rows).any():
        raise ValueError("missing values in the features or the target")
    return np.ascontiguousarray(rows[:, 1:]), rows[:, 0].copy()


def _run(spark: SparkSession, jobs: list, step, schema: str) -> DataFrame:
    """``step(job)`` gives columns of numpy arrays; one task per job."""
    names = [part.split()[0] for part in schema.split(", ")]
    held = spark.sparkContext.broadcast(jobs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                for columns in step(held.value[number]):
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)

    return spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, schema)


def staged_parts(model: str, train: DataFrame, names: list[str], settings: list[tuple[dict, list[int]]], folds: int, label: str, index: str) -> DataFrame:
    """Parts of the predictions of all held-out rows: of the trees up to ``stop``, from the stop before on.

    ``settings`` are pairs of parameters without the number of trees, and the numbers asked for.
    """
    spark = train.sparkSession
    x, y = _arrays(train, names, label, index)
    if len(y) <= folds:
        raise ValueError("too few rows for the folds")
    data = spark.sparkContext.broadcast((x, y))
    bounds = [(b["fold"], b["test_start"], b["test_end"]) for b in fold_bounds(train, folds).orderBy("fold").collect()]
    jobs = []
    for (number, (params, stops)), bound in itertools.product(enumerate(settings), bounds):
        if model == "Random_Forest":
            edges = sorted({*stops, *range(0, max(stops), BLOCK)})
            jobs += [(number, params, bound, start, [stop]) for start, stop in itertools.pairwise(edges)]
        else:
            jobs.append((number, params, bound, 0, sorted(set(stops))))
    rate = [params.get("learning_rate", 0.1) if model == "Gradient_Boosting" else 1.0 for params, _ in settings]

    def step(job):
        number, params, (fold, start, end), first, stops = job
        x, y = data.value
        table = Table(x[:start], y[:start])
        part, position = np.zeros(end - start), np.arange(start, end)
        if model == "Gradient_Boosting":
            part += table.y.mean()
        for made, tree in enumerate(trees_of(model, table, params, first, stops[-1]), first + 1):
            part += rate[number] * tree.predict(x[start:end])
            if made in stops:
                same = np.ones(len(part), np.int64)
                yield same * number, same * fold, same * made, position, y[start:end], part
                part = np.zeros(end - start)

    return _run(spark, jobs, step, "setting long, fold long, stop long, position long, actual double, part double")


def search(
    model: str, train: DataFrame, names: list[str], candidates: list[dict], folds: int = V.FOLDS, label: str = V.TARGET, index: str = "split_index"
) -> Search:
    """Mean squared error of every candidate over expanding folds, and the best one fitted on all rows."""
    spark = train.sparkSession
    default = 100
    counts = [int(params.get("n_estimators", default)) for params in candidates]
    shared: dict[str, tuple[dict, list[int]]] = {}
    setting = []
    for params, count in zip(candidates, counts):
        rest = {name: value for name, value in params.items() if name != "n_estimators"}
        key = json.dumps(rest, sort_keys=True)
        shared.setdefault(key, (rest, []))[1].append(count)
        setting.append(list(shared).index(key))
    parts = settle(staged_parts(model, train, names, list(shared.values()), folds, label, index), "staged")
    asked = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(zip(setting, counts))], "candidate long, setting long, trees long")
    divisor = F.col("trees") if model == "Random_Forest" else F.lit(1)
    predicted = (
        parts.join(F.broadcast(asked), "setting")
        .where(F.col("stop") <= F.col("trees"))
        .groupBy("candidate", "trees", "fold", "position")
        .agg(F.sum("part").alias("sum"), F.first("actual").alias("actual"))
    )
    errors = predicted.groupBy("candidate", "fold").agg(F.avg((F.col("actual") - F.col("sum") / divisor) ** 2).alias("mse"))
    rows = sorted(tuple(row) for row in errors.collect())  # candidates x folds
    means = [sum(mse for c, _, mse in rows if c == i) / folds for i in range(len(candidates))]
    best = candidates[int(np.argmin(means))]
    fold_scores = [(candidates[c], fold, mse) for c, fold, mse in rows]
    scores = list(zip(candidates, means))
    return Search(model, best, fit(model, train, names, best, label, index), min(means), scores, fold_scores, len(shared) * folds)


def fit(model: str, train: DataFrame, names: list[str], params: dict, label: str = V.TARGET, index: str = "split_index") -> TreeModel:
    """One model on all rows; a forest is grown by several tasks."""
    spark = train.sparkSession
    x, y = _arrays(train, names, label, index)
    data = spark.sparkContext.broadcast((x, y))
    trees = int(params.get("n_estimators", 100))
    edges = [*range(0, trees, BLOCK if model == "Random_Forest" else trees), trees]

    def step(job):
        start, stop = job
        for number, tree in enumerate(trees_of(model, Table(*data.value), params, start, stop), start):
            places = np.arange(len(tree.value))
            yield np.full(len(places), number), places, tree.feature, tree.limit, tree.left, tree.value

    schema = "tree long, node long, feature long, limit double, left long, value double"
    nodes = settle(_run(spark, list(itertools.pairwise(edges)), step, schema), "trees")
    if model == "Random_Forest":
        return TreeModel(model, names, 0.0, 1.0 / trees, nodes)
    return TreeModel(model, names, float(y.mean()), params.get("learning_rate", 0.1), nodes)
