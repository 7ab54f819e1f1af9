"""Trees against a plain recursion, staged errors against models grown one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import models as M
from shiftlode.operators import trees as T

NAMES = ["a", "b", "c"]


def plain_tree(x, y, w, depth, leaf, split):
    """Predictions by recursion over rows with weights."""

    def build(rows, level):
        mean = np.average(y[rows], weights=w[rows])
        best = None
        if (depth is None or level < depth) and len(rows) >= split:
            for f in range(x.shape[1]):
                for low, high in zip(*(lambda v: (v[:-1], v[1:]))(np.unique(x[rows, f]))):
                    middle = low + (high - low) / 2
                    left, right = rows[x[rows, f] <= middle], rows[x[rows, f] > middle]
                    if min(len(left), len(right)) < leaf:
                        continue
                    gain = sum(np.sum(w[p] * y[p]) ** 2 / np.sum(w[p]) for p in (left, right)) - np.sum(w[rows] * y[rows]) ** 2 / np.sum(w[rows])
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, middle, left, right)
        if best is None:
            return lambda row: mean
        _, f, middle, left, right = best
        low, high = build(left, level + 1), build(right, level + 1)
        return lambda row: low(row) if row[f] <= middle else high(row)

    tree = build(np.nonzero(w > 0)[0], 0)
    return np.array([tree(row) for row in x])


@pytest.mark.parametrize("depth, leaf, split", [(None, 1, 2), (3, 1, 2), (None, 4, 2), (None, 2, 12), (0, 1, 2)])
def test_tree_equals_the_recursion(depth, leaf, split):
    source = np.random.default_rng(5)
    for _ in range(6):
        x = np.column_stack([source.integers(0, 5, 70), source.normal(size=70), np.zeros(70)])
        y, w = source.normal(size=70), source.integers(0, 3, 70).astype(float)
        params = {"max_depth": depth, "min_samples_leaf": leaf, "min_samples_split": split}
        np.testing.assert_allclose(T.Table(x, y).tree(y, w, params).predict(x), plain_tree(x, y, w, depth, leaf, split), atol=1e-9)


def test_equal_targets_and_single_rows_are_leaves():
    x = np.arange(6.0).reshape(-1, 1)
    assert len(T.Table(x, np.ones(6)).tree(np.ones(6), np.ones(6), {}).value) == 1
    assert T.Table(x[:1], np.ones(1)).tree(np.ones(1), np.ones(1), {}).predict(x).tolist() == [1] * 6


@pytest.fixture(scope="module")
def train(spark):
    hashed = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 100).alias(name) for i, name in enumerate(NAMES)]
    rows = spark.range(120).select(F.col("id").alias("split_index"), *hashed)
    return rows.withColumn(V.TARGET, F.col("a") * 10 + F.col("b") * F.col("c") + F.col("split_index") / 50).cache()


def arrays(train):
    rows = train.orderBy("split_index").toPandas()
    return rows[NAMES].to_numpy(float), rows[V.TARGET].to_numpy(float)


GRIDS = {
    "Random_Forest": {"n_estimators": [30, 5, 12], "max_depth": [2, None]},
    "Gradient_Boosting": {"n_estimators": [3, 8], "learning_rate": [0.1, 0.3], "subsample": [0.6, 1.0]},
}


def guess(model, x, y, params, other):
    """The model grown alone, with its own number of trees."""
    table, number = T.Table(x, y), params["n_estimators"]
    values = [tree.predict(other) for tree in T.trees_of(model, table, params, 0, number)]
    return sum(values) / number if model == "Random_Forest" else y.mean() + params["learning_rate"] * sum(values)


@pytest.mark.parametrize("model", T.MODELS)
def test_staged_errors(spark, train, model):
    candidates = M.parameter_draws(GRIDS[model])
    found = T.search(model, train, NAMES, candidates, folds=3)
    x, y = arrays(train)
    for params, fold, mse in found.fold_scores:
        start = 30 + 30 * fold
        error = y[start : start + 30] - guess(model, x[:start], y[:start], params, x[start : start + 30])
        assert mse == pytest.approx(np.mean(error**2), rel=1e-9)
    assert len(found.fold_scores) == 3 * len(candidates)
    shared = len(candidates) // len(GRIDS[model]["n_estimators"])
    assert found.fits == 3 * shared
    assert found.cv_mse == min(score for _, score in found.scores) and dict((str(p), s) for p, s in found.scores)[str(found.params)] == found.cv_mse
    np.testing.assert_allclose(found.fitted.predict(x), guess(model, x, y, found.params, x), rtol=1e-9)


@pytest.mark.parametrize("model", T.MODELS)
def test_stored_models_predict_the_same(spark, train, model, tmp_path):
    tuned = M.search_trees(model, train, NAMES, {"n_estimators": [4], "learning_rate": [0.2]}, folds=2)
    loaded = M.load_model(M.save_model(tuned, str(tmp_path)))
    x, _ = arrays(train)
    rows = loaded.transform(train.withColumn("more", F.lit("kept"))).orderBy("split_index").toPandas()
    np.testing.assert_allclose(rows["prediction"], tuned.fitted.predict(x), rtol=1e-12)
    assert list(rows["more"].unique()) == ["kept"]


def test_subsample_leaves_rows_out():
    x = np.random.default_rng(1).normal(size=(50, 2))
    table = T.Table(x, x[:, 0])
    whole, part = (next(T.boosted_trees(table, {"subsample": s, "max_depth": None}, 1)) for s in (1.0, 0.5))
    assert (whole.feature == T.LEAF).sum() == 50 and (part.feature == T.LEAF).sum() == 25


def test_refused_tables(spark, train, monkeypatch):
    with pytest.raises(ValueError, match="too few"):
        T.search("Random_Forest", train.limit(3), NAMES, [{}], folds=5)
    with pytest.raises(ValueError, match="missing"):
        T.fit("Random_Forest", train.withColumn("a", F.lit(None).cast("double")), NAMES, {})
    monkeypatch.setattr(T, "MOST_ROWS", 100)
    with pytest.raises(ValueError, match="models.tune"):
        T.fit("Random_Forest", train, NAMES, {})
