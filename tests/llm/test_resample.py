"""Importance resampling against plain code, on small tables with every odd case."""

import hashlib
import math
import re
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftlode.llm import resample
from shiftlode.llm.resample import BUCKETS, LEAST_WORDS, feature_codes

SCHEMA = "doc_id long, text string, rank string"  # a column that clashes with the result


def plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows, target, share):
    def bucket(feature):
        return crc32(feature.encode()) % BUCKETS

    s, t = [0] * BUCKETS, [0] * BUCKETS
    for _, text in rows:
        for f in plain_features(text)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + BUCKETS) / ((a + 1) * (sum(t) + BUCKETS)))) for a, b in zip(s, t)]
    out = []
    for key, text in rows:
        n, features = plain_features(text)
        weight = math.floor(sum(gain[bucket(f)] for f in features) / len(features)) if features else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = [i for i, row in enumerate(out) if row[1] >= LEAST_WORDS]
    able.sort(key=lambda i: (-out[i][4], out[i][0] is None, out[i][0] or 0))
    rank = {i: place for place, i in enumerate(able[: share * len(able) // 100], 1)}
    return [(*row, rank.get(i)) for i, row in enumerate(out)]


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple((x is None, x or 0) for x in row))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\x00aZ9é/\x7f日_", max_size=60), st.integers(1, 9))
def test_features_by_slices(text, size):
    whole = plain_features(text)
    old, resample.SLICE = resample.SLICE, size
    try:
        parts = list(feature_codes(text))
    finally:
        resample.SLICE = old
    assert sum(n for n, _ in parts) == whole[0]
    assert sorted(c for _, codes in parts for c in codes) == sorted(crc32(f.encode()) for f in whole[1])


def texts():
    some = [f"the Word{i % 7} of ordinary prose number {i} " * (2 + i % 5) for i in range(60)]
    return some + [None, "", "ÄÖ.ü " * 30, "x" * 70_000, "a b " * 30_000, "few words"]


@pytest.mark.parametrize("share", [0, 25, 60, 100])
def test_draw(spark, share):
    rows = list(enumerate(texts()))
    rows += [(5, rows[5][1])] * 40 + [(None, rows[6][1])] * 30 + [(-3, rows[7][1])]  # ties in score and id
    target = ["ordinary prose of the target", None, "word3 of Word4"]
    found = resample.resample(
        spark.createDataFrame([(*row, "x") for row in rows], SCHEMA).repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), share=share
    ).collect()
    assert ordered(found) == ordered(plain(rows, target, share))


def test_hot_row(spark):
    """One row is most of the table: the cutoff and the ranks go through its copies."""
    text = "the same forty words " * 10
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 1, id) AS doc_id", f"'{text}' AS text")
    ranks = [row["rank"] for row in resample.resample(docs, docs.limit(2)).collect()]
    assert sorted(r for r in ranks if r is not None) == list(range(1, 751)) and len(ranks) == 3000


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "one two three " * 10, "")], SCHEMA)
    assert resample.resample(empty, some).count() == 0
    row = resample.resample(some, empty, share=100).first()
    assert row["rank"] == 1 and row.n_features == 59
