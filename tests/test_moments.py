import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftlode import fixed_values as V
from shiftlode.operators import models as M
from shiftlode.operators import moments as B
from shiftlode.session import new_path

NAMES = ["a", "b", "c"]
GRID = {"alpha": [0.1, 1.0, 10.0, 100.0]}


@pytest.fixture(scope="module")
def rows(spark):
    """Far from zero, one column nearly the sum of the others, one constant."""
    rng = np.random.default_rng(11)
    x = rng.normal(0, 3, (607, 3)) + [1e6, -40, 0]
    x[:, 2] = x[:, 0] + x[:, 1] + rng.normal(0, 0.1, len(x))
    y = 2 * x[:, 1] - 0.5 * x[:, 2] + rng.normal(0, 1, len(x)) + 5e5
    frame = pd.DataFrame(x, columns=NAMES).assign(flat=0.1, **{V.TARGET: y}, split_index=range(len(x)))
    return frame, spark.createDataFrame(frame).repartition(7)


def test_blocks_add_up_to_all_rows(rows):
    frame, df = rows
    names = [*NAMES, V.TARGET]
    blocks = B.collect_moments(df, names, F.col("split_index") % 5)
    assert sorted(blocks) == list(range(5)) and sum(m.rows for m in blocks.values()) == len(frame)
    for block, found in blocks.items():
        part = frame[frame.split_index % 5 == block][names]
        np.testing.assert_allclose(found.means, part.mean(), rtol=1e-12)
        np.testing.assert_allclose(found.products / found.rows, part.cov(ddof=0), rtol=1e-8)
    total = B.total(list(blocks.values()), names)
    np.testing.assert_allclose(total.products / total.rows, frame[names].cov(ddof=0), rtol=1e-8)
    np.testing.assert_allclose(total.std(), frame[names].std(ddof=0), rtol=1e-9)


def test_correlations_and_missing_values(spark, rows):
    frame, df = rows
    got = B.correlation_rows(df, [*NAMES, "flat"]).toPandas().pivot(index="row_name", columns="column_name", values="correlation")
    np.testing.assert_allclose(got.loc[NAMES, NAMES], frame[NAMES].corr(), rtol=1e-8)
    assert got["flat"].isna().all() and got.loc["flat"].isna().all()
    holes = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (None, 9.0), (float("nan"), 9.0), (4.0, 3.0)], "a double, b double")
    found = B.collect_moments(holes, ["a", "b"])[0]
    assert found.rows == 3 and found.means.tolist() == pytest.approx([7 / 3, 2.0])
    assert B.collect_moments(holes.where("a > 100"), ["a", "b"]) == {}
    assert {r["correlation"] for r in B.correlation_rows(holes.where("a > 100"), ["a", "b"]).collect()} == {None}


def plain_ridge(x, y, alpha, scale):
    """Coefficients by solving the normal equations of the rows themselves."""
    z = (x - x.mean(axis=0)) / scale
    return np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean())) / scale


def test_folds_equal_plain_fits(rows):
    frame, df = rows
    tuned = M.search_linear("Ridge_Regression", df, NAMES, GRID)
    x, y = frame[NAMES].to_numpy(), frame[V.TARGET].to_numpy()
    scale, size = x.std(axis=0), len(x) // 6
    for params, fold, mse in tuned.fold_scores:
        start = len(x) - (5 - fold) * size
        b = plain_ridge(x[:start], y[:start], params["alpha"], scale)
        guess = y[:start].mean() + (x[start : start + size] - x[:start].mean(axis=0)) @ b
        assert mse == pytest.approx(np.mean((y[start : start + size] - guess) ** 2), rel=1e-6)
    assert len(tuned.fold_scores) == 20 and len(tuned.scores) == 4
    assert tuned.params == min(tuned.scores, key=lambda item: item[1])[0]


def test_search_equals_the_fits_of_spark(rows):
    frame, df = rows
    ours, theirs = (way("Ridge_Regression", df, NAMES, GRID) for way in (M.search_linear, M.tune))
    assert ours.params == theirs.params
    for (params, mse), (other, error) in zip(ours.scores, theirs.scores):
        assert params == other and mse == pytest.approx(error, rel=1e-5)
    got, want = (
        t.fitted.transform(df).orderBy("split_index").toPandas()["prediction"] for t in (ours, theirs)
    )
    np.testing.assert_allclose(got, want, rtol=1e-7)


def test_least_squares_constant_and_repeated_columns(rows):
    """A constant column counts for nothing; of two equal columns each takes half."""
    frame, df = rows
    twice = df.withColumn("again", F.col("a"))
    tuned = M.search_linear("Linear_Regression", twice, ["a", "again", "b", "flat"], {})
    first, second, _, flat = tuned.fitted.coefficients
    assert first == pytest.approx(second, rel=1e-6) and flat == 0.0 and tuned.cv_mse is None
    x, y = frame[["a", "b"]].to_numpy(), frame[V.TARGET].to_numpy()
    design = np.column_stack([np.ones(len(x)), x - x.mean(axis=0)])
    want = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    got = tuned.fitted.transform(twice).orderBy("split_index").toPandas()["prediction"]
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_one_pass_over_the_features(spark, rows, tmp_path):
    """The features are read once for all folds and penalties; the count reads no column."""
    _, df = rows
    path = str(tmp_path / "t")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    state = B.block_moments(stored, [*NAMES, V.TARGET], M.fold_block(stored))
    state.collect()
    plan = state._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert plan.split("== Initial Plan ==")[0].count("Scan parquet") == 1
    schemas = {line.strip() for line in plan.splitlines() if line.startswith("ReadSchema")}
    assert len(schemas) == 2 and "ReadSchema: struct<>" in schemas


def test_stored_models_predict_the_same(spark, rows):
    _, df = rows
    tuned = M.search_linear("Ridge_Regression", df, NAMES, {"alpha": [1.0]})
    loaded = M.load_model(M.save_model(tuned, new_path(spark, "models")))
    assert loaded == tuned.fitted
    assert loaded.transform(df.withColumn("a", F.lit(None).cast("double"))).where("prediction IS NOT NULL").count() == 0


def test_too_few_rows_are_an_error(rows):
    _, df = rows
    with pytest.raises(ValueError):
        M.search_linear("Linear_Regression", df.where("split_index < 0"), NAMES, {})
