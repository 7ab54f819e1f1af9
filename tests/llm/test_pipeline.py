"""The stages after one another: columns, decisions, and digests of what is left."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shiftlode.llm.common import words_of


@pytest.fixture(scope="module")
def stages(spark, folder):
    small = folder.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], small).cache()))
    return out


def test_every_stage_but_the_last_has_the_columns_of_documents(stages):
    for _, docs in stages[:-1]:
        assert docs.columns == stages[0][1].columns


def test_filters_keep_rows_as_they_are(stages):
    for (_, before), (_, after) in list(zip(stages, stages[1:]))[:3]:
        assert after.exceptAll(before).count() == 0
        assert 0 < after.count() <= before.count()


def test_clean_documents_stay_and_bad_ones_go(spark, folder, stages):
    labels = spark.read.parquet(f"{folder}/labels.parquet".replace("sf0.001", "sf0.01"))
    judged = stages[1][1].join(labels, "doc_id").filter("n_chars > 1000")
    kept = {r["doc_id"] for r in stages[2][1].select("doc_id").collect()}
    good = [r["doc_id"] in kept for r in judged.filter("quality = 1").collect()]
    bad = [r["doc_id"] in kept for r in judged.filter("quality = 0").collect()]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)  # few labels here


def test_mixture_repeats_at_most_twice(stages):
    counts = [r["count"] for r in stages[4][1].groupBy("doc_id").count().collect()]
    assert max(counts) == 2 and stages[4][1].select("doc_id").exceptAll(stages[3][1].select("doc_id").unionAll(stages[3][1].select("doc_id"))).count() == 0


def test_tokens(spark, folder, stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for row in stages[4][1].collect():
        ids = library.encode(row["text"], add_special_tokens=False).ids
        want.append((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(row["text"].encode()).hexdigest()))
    assert sorted(map(tuple, stages[5][1].collect())) == sorted(want)
    again = corpus_pipeline.run(spark, folder.replace("sf0.001", "sf0.01"))
    assert sorted(map(tuple, again.collect())) == sorted(want)


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_odd_rows(spark, folder):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 300_000, "en", "s", 1), (2, "word " * 300_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert name == "bpe_transducer" or out.columns == docs.columns
        out.collect()
    assert words_of(None) == []
