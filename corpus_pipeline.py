"""Stages from raw documents to tokens. Each reads what the stage before has written."""

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shiftlode.llm import evidence, forest, paths
from shiftlode.llm.bpe import bpe_digest
from shiftlode.llm.common import table
from shiftlode.llm.entropy import mixed_rows
from shiftlode.session import new_path


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a known language stay."""
    return evidence.kept_rows(docs)


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the rules and the isolation forest stay."""
    return forest.kept_rows(docs, forest.fit(docs, table(spark, folder, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return paths.first_rows(docs)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Tokens of every document, as digests."""
    return bpe_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_evidence", language),
    ("isolation_forest", quality),
    ("chosen_path_join", near_copies),
    ("entropy_mix", mixture),
    ("bpe_transducer", tokens),
]

# Naive Bayes, the forest and BPE cannot be said in SQL; the tests check the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the documents of ``folder``; their results go through the shared folder."""

    def stage(docs: DataFrame, named: tuple) -> DataFrame:
        path = new_path(spark, named[0])
        named[1](spark, docs, folder).write.parquet(path)
        return spark.read.parquet(path)

    return reduce(stage, STAGES, table(spark, folder, "documents"))
