"""Block files: exact round trips and the ids of the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shiftlode.llm import pfor
from shiftlode.llm.pfor import WordEncoder, blocks_round_trip, pack, unpack_range
from shiftlode.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 32), st.integers(0, 40), st.sampled_from([0.0, 0.5, 0.9, 1.0]), st.integers(0, 9))
def test_round_trip(size, bits, outliers, percentile, seed):
    source = np.random.default_rng(seed)
    ids = source.integers(0, 1 << bits, size, dtype=np.uint64).astype(np.uint32)
    ids[source.integers(0, size, outliers if size else 0)] = source.integers(0, 1 << 32, outliers if size else 0)
    payload = pack(ids, percentile)
    assert np.array_equal(unpack_range(payload), ids)
    first, stop = sorted(source.integers(0, size + 1, 2).tolist())
    assert np.array_equal(unpack_range(payload, first, stop), ids[first:stop])


def test_outliers_do_not_widen_the_block():
    ids = np.arange(1024, dtype=np.uint32) % 16
    spread = ids.copy()
    spread[5] = 4_000_000_000
    assert len(pack(spread)) == len(pack(ids)) + 6


def expected(text):
    ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'streΣσABß1<|>́\x1f  "), st.characters(exclude_categories=["Cs", "Cn"])), max_size=50))
def test_ids_equal_the_library(text):
    assert np.frombuffer(WORDS.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" 'sStTrReE.,!aBß1½\xa0\x85\x1f\x7f"), st.characters(max_codepoint=255)), max_size=60))
def test_ids_of_latin_texts(text):
    assert np.frombuffer(WORDS.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


WORDS = WordEncoder(PATH)


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(pfor, "CACHED_WORDS", 4)
    own = WordEncoder(PATH)
    for text in ["a b c", "d e f g h i", "a b " + "x" * 99, "b c d e " + "y" * 70 + " a"]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 4


@pytest.mark.parametrize("segment", [1, 50, 1 << 20])
def test_rows(spark, segment):
    texts = [None, "", "Hello <|endoftext|> World", "x " * 5000, "long" * 9000, "same", "same"] + [f"t {i} é" for i in range(40)]
    rows = [(i * 7 % 50 if i < 5 or i > 6 else 3, text, 1) for i, text in enumerate(texts)] + [(None, "nobody", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    start, want = 0, []
    for number, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        length, check = expected(text)
        want.append((number, start, length, check))
        start += length
    got = sorted(map(tuple, blocks_round_trip(df, PATH, 2, segment_ids=segment).collect()), key=lambda r: r[1])
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert blocks_round_trip(df, PATH, 2).count() == 0


def test_equal_rows_lie_in_several_ranges(spark):
    """Rows with one id, all of them null here, are dealt over the write tasks; places and checksums stay right."""
    docs = spark.range(6000).selectExpr("CAST(NULL AS LONG) AS doc_id", "IF(id % 4 = 0, 'one text', 'another text here') AS text")
    target = new_path(spark, "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges as a large table has them
    try:
        pfor.write_blocks(docs, PATH, 2, target, segment_ids=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["n"] for row in spark.read.parquet(target).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2500 and sum(sizes) == 6000
    rows = pfor.read_blocks(spark, target).orderBy("start").collect()
    assert {(row.n_tokens, row.ids_crc32) for row in rows} == {expected("one text"), expected("another text here")}
    assert [row.start for row in rows] == np.cumsum([0] + [row.n_tokens for row in rows])[:-1].tolist()
