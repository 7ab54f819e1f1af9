"""Rule counts against plain code; the forest on labelled rows it has not seen."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftlode.llm import forest
from shiftlode.llm.forest import COUNTS, Forest, base_failed, expected_path, fit, judge, kept_rows, rule_counts


def plain(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + j for i, t in enumerate(triples) if triples.count(t) > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated),
        len(re.findall("[A-Z]", text)), text.count("!"),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x0b\x0c\r\x1c\x85\xa0abÉA!#|<", max_size=80))
def test_counts(text):
    assert rule_counts(text) == plain(text)


def test_isolation():
    source = np.random.default_rng(0)
    rows = np.vstack([source.normal(0, 1, (2000, 3)), [[9, 9, 9], [-9, 9, -9]]])
    scores = Forest(rows).score(rows)
    assert (scores[2000:] > np.quantile(scores, 0.99)).all()
    assert expected_path(1) == 0 and abs(expected_path(256) - 10.24) < 0.01


def test_verdicts(spark, folder):
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet".replace("sf0.001", "sf0.1")) for name in ("documents", "labels"))
    verdict = fit(documents, labels.filter("doc_id % 2 = 0"))
    held_out = documents.join(labels, "doc_id").filter("doc_id % 2 = 1")
    quality = {row["doc_id"]: row["quality"] for row in held_out.select("doc_id", "quality").collect()}
    rows = judge(held_out, verdict).collect()
    good = [row for row in rows if quality[row["doc_id"]] and not row["base_failed"]]
    bad = [row for row in rows if not quality[row["doc_id"]]]
    assert sum(row["kept"] for row in good) >= 0.99 * len(good)
    assert sum(row["kept"] for row in bad) <= 0.03 * len(bad)


def test_rows(spark):
    fine = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, " \n "), (4, fine), (4, fine), (None, fine), (5, "x " * 500_000), (6, "y" * 200_000), (7, "a\nb\na\n\n")]
    df = spark.createDataFrame([(*row, "score") for row in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(None, 1), (4, None), (9, 1)], "doc_id long, quality int")
    verdict = fit(df, labels)
    got = judge(df, verdict).collect()
    key = lambda r: (r[0] is None, r)
    counted = [(n, *plain(t or "")) for n, t in rows if n != 5] + [(5, 500_000, 500_000, 0, 0, 500_000, 0, 0)]
    assert sorted([tuple(r)[:8] for r in got], key=key) == sorted(counted, key=key)
    failed = base_failed(np.array([tuple(r)[1:8] for r in got]))
    assert [r["base_failed"] for r in got] == failed.tolist() and [r["kept"] for r in got] == (~failed).tolist()
    assert sorted([tuple(r) for r in kept_rows(df, verdict).collect()], key=key) == sorted([(*r, "score") for r in rows if r[1] == fine], key=key)
    empty = df.limit(0)
    assert judge(empty, fit(empty, labels.limit(0))).count() == 0
    assert judge(empty, verdict).columns == ["doc_id", *COUNTS, "base_failed", "score", "kept"]


def test_repeated_labelled_rows_come_once(spark, monkeypatch):
    """A labelled id on most rows sends one row to the driver."""
    fine = " ".join(f"w{i}" for i in range(80))
    docs = spark.range(3000).selectExpr("IF(id < 2000, 7, id) AS doc_id", f"IF(id % 50 = 3, '!!! {fine} !!!', '{fine}') AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 50 <> 3 AS INT) AS quality")
    seen, plain_counted = [], forest.counted
    monkeypatch.setattr(forest, "counted", lambda df, *rest: seen.append(df.count()) or plain_counted(df, *rest))
    assert fit(docs, labels).forest is not None and seen == [1001]


def test_all_labelled_rows_fit(spark, monkeypatch):
    """Every labelled row counts in the trees and in the threshold, also where there are many; the rows may lie anywhere."""
    fine = [f"w{i}" for i in range(80)]
    source = np.random.default_rng(3)
    texts = [" ".join(w + "#" * int(k > source.integers(0, 80)) for w in fine) for k in range(60)]
    rows = [(i, texts[int(source.exponential(6)) % 60] if i % 20 else "###### " * 10 + " ".join(fine)) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.range(12_000).selectExpr("id AS doc_id", "CAST(id % 20 > 0 AS INT) AS quality")
    tables, plain_counted = [], forest.counted
    monkeypatch.setattr(forest, "counted", lambda df: tables.append(plain_counted(df)) or tables[-1])
    verdict = fit(docs, labels)
    assert tables[0].selectExpr("sum(n0)", "sum(n1)").first()[:] == (11_400, 600)
    counts = np.array([rule_counts(text) for _, text in rows], np.int64)
    seen, good = forest.rates(counts), np.arange(12_000) % 20 > 0
    numbers = np.stack([good, ~good], axis=1).astype(np.int64)
    whole = Forest(ranges=lambda trees, level: forest.node_ranges(trees, seen, numbers, level), weights=(1.0, 1 / 600))
    assert (whole.feature == verdict.forest.feature).all() and (whole.value == verdict.forest.value).all()
    scores = whole.score(seen)
    assert verdict.threshold == np.quantile(scores[good], 1 - forest.LOSS, method="higher")
    assert not verdict(counts[~good])[2].any() and verdict(counts[good])[2].mean() >= 1 - forest.LOSS
