"""Targets against a plain water filling, copies against the targets."""

import math

import numpy as np
from pyspark.sql import functions as F

from shiftlode.llm.common import word_count
from shiftlode.llm import entropy
from shiftlode.llm.entropy import mix, mixed_rows, source_targets, tilts


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, held = share * sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in held]
        rest = total - sum(limit * sizes[s] for s in held)
        target = {s: limit * sizes[s] if s in held else rest * weight[s] / sum(weight[x] for x in free) for s in sizes}
        above = {s for s in free if target[s] > limit * sizes[s]}
        if not above:
            return target
        held |= above


def test_targets_and_tilts(spark):
    sizes = {"b": 1000, "a": 10, None: 400, "é": 5000, "z": 1, "": 70, "\U0001f642": 30, "￮": 3, "none": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r for r in tilts(source_targets(df)).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(sizes)
    for source, row in got.items():
        assert math.isclose(row["target"], want[source], rel_tol=1e-12, abs_tol=1e-9)
        assert math.isclose(row["rate"] * sizes[source], want[source], rel_tol=1e-9, abs_tol=1e-9)


def documents(spark, n=3000):
    source = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(source.lognormal(3, 1))), f"s{min(i % 20, 7) if i % 3 else 0}", "x") for i in range(n)]
    rows += [(n, None, "s1", "x"), (n + 1, "", None, "x"), (n + 2, "a\x0bb c \x1fd", None, "x"), (n + 3, "x y", "s1", "x"), (n + 3, "x y", "s1", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_mix(spark):
    rows, df = documents(spark)
    got = mix(df).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want = plain_targets(sizes)
    taken, number = {}, {r[0]: r[2] for r in rows}
    for row in got:
        assert 0 <= row["taken"] <= 2 * row["size"] and row["taken"] % max(row["size"], 1) == 0
        assert row["source_size"] == sizes[number[row["doc_id"]]]
        taken[number[row["doc_id"]]] = taken.get(number[row["doc_id"]], 0) + row["taken"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 5
    again = mix(df.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mixed_rows_repeat_the_documents(spark):
    rows, df = documents(spark, 300)
    got = mixed_rows(df)
    assert got.columns == df.columns
    words = lambda frame: {r[0]: r[1] for r in frame.groupBy("doc_id").agg(F.sum(word_count("text"))).collect()}
    taken = {r[0]: r[1] for r in mix(df).groupBy("doc_id").agg(F.sum("taken")).collect() if r[1]}
    assert words(got) == taken


def test_word_count(spark):
    texts = [None, "", " ", "a", "  a\tb\n\n c\x0b\x0cd\r ", "a b \x1f", "é " * 400]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(word_count("text")).collect()] == [len((t or "").encode().split()) for t in texts]


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r)[:5] for r in mix(spark.createDataFrame([(1, None, "a")], schema)).collect()] == [(1, 0, 0, 0.0, 0)]
    assert mixed_rows(spark.createDataFrame([(1, None, "a")], schema)).count() == 0


def test_equal_rows_are_spread_over_groups(spark):
    """One row is a third of all; no group gets many of it, and the targets are met all the same."""
    docs = spark.range(9000).selectExpr("IF(id % 3 = 0, 0, id) AS doc_id", "'s' AS source", "CAST(7 AS LONG) AS size", "1L AS tie")
    rates = spark.createDataFrame([("s", 63000, 94500.0, 1.5)], "source string, source_size long, target double, rate double")
    counts = spark.createDataFrame([("s", 9000)], "source string, documents long")
    dealt = entropy._dealt(docs).collect()
    assert len(dealt) == 9000 and max(row.deal for row in dealt) == 29
    rows = entropy._rounded(docs, rates, counts).collect()
    assert len(rows) == 9000 and abs(sum(row.copies * row["size"] for row in rows) - 94500) < 9 * 7
    assert {row.copies for row in rows} <= {1, 2}
