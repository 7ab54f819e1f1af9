"""Block join against brute force, with ties, copies and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlode.llm.blocks import Block, nearest, tile, valid_vectors

NAN, INF = float("nan"), float("inf")


def brute(rows, k, wanted):
    clean = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for query in sorted({i for i, _ in clean if wanted(i)}):
        q = np.array(min(v.tolist() for i, v in clean if i == query))
        scored = [(-np.cumsum(q * v)[-1] / (np.sqrt(np.cumsum(q * q)[-1]) * np.sqrt(np.cumsum(v * v)[-1])), i) for i, v in clean if i != query and len(v) == len(q)]
        out += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("size, blocks", [(400, (3, 50)), (400, (1024, 4096)), (3, (1, 1))])
def test_equals_brute_force(spark, size, blocks):
    source = np.random.default_rng(3)
    rows = [(int(i), source.normal(size=16).astype(np.float32).tolist(), "x") for i in range(size)]
    rows += [(1000, rows[0][1], "copy"), (1001, rows[0][1], "copy"), (1001, rows[0][1], "copy"), (20, [1.0] * 16, "again")]
    rows += [(40 + 10 * i, v, "bad") for i, v in enumerate([None, [], [0.0] * 16, [NAN] * 16, [None] * 16, [INF] * 16])]
    rows += [(None, rows[0][1], "no id"), (600, [1.0, 2.0], "short"), (601, [2.0, 1.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = sorted(map(tuple, nearest(df, F.col("vec_id") % 10 == 0, 5, query_rows=blocks[0], stripe_rows=blocks[1]).collect()))
    expected = brute(rows, 5, lambda i: i % 10 == 0)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], rtol=0, atol=1e-15)


def test_bounds_hold():
    source = np.random.default_rng(1)
    a, b = (Block(range(50), source.normal(size=(50, 8)) ** 3) for _ in range(2))
    near = (a.codes.astype(int) @ b.codes.astype(int).T) * a.scales[:, None] * b.scales
    exact = (a.vectors @ b.vectors.T) / (a.norms[:, None] * b.norms)
    assert (np.abs(near - exact) <= a.lost[:, None] * (1 + b.lost) + b.lost + 1e-12).all()


def test_tiny_and_wide_vectors():
    vectors = np.random.default_rng(2).normal(size=(30, 1500))
    vectors[::2] *= 1e-200
    block = Block(range(30), vectors)
    got = {(q, c) for q, c, _ in tile(block, block, 3)}
    unit = vectors / np.abs(vectors).max(axis=1)[:, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    cosine = unit @ unit.T - 2 * np.eye(30)
    assert got == {(q, int(c)) for q in range(30) for c in np.argsort(-cosine[q])[:3]}


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, F.col("vec_id") % 10 == 0).count() == 0


def test_vectors_are_sent_as_they_are_stored(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=6)]) for i in range(30)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        assert dict(valid_vectors(df, "vec_id", "embedding").dtypes)["v"] == f"array<{kind}>"
        got = sorted(map(tuple, nearest(df, F.col("vec_id") % 5 == 0).collect()))
        assert [r[:3] for r in got] == [r[:3] for r in brute(rows, 5, lambda i: i % 5 == 0)]
