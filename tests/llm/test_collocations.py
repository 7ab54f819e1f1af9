"""Collocations against plain code: counts of blocks, scores beyond 64 bits, covering phrases, odd rows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftlode.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, n string, w1 string"  # columns that clash with those inside


def plain_pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", lowered)]


def plain_counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for words in plain_pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def plain(rows, least, most, keep=100):
    f, n = plain_counts(rows)
    f = {key: times for key, times in f.items() if times >= least}
    best = {}
    for (lang, p), a in f.items():
        around = [g for (other, q), g in f.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if len(p) < 2 or any(100 * g >= keep * a for g in around):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in best.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1)
    )


def windows_of(rows):
    """Counts of all phrases from the blocks of one task, with nothing cut."""
    f, n = Counter(), Counter()
    for block in c.blocks([pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows])], ["text", "lang"])]):
        words = block.words.to_pylist()
        for i in range(block.starts):
            if block.is_word[i]:
                lang, size = block.names[block.group[i]], 1
                n[lang] += 1
                while size < c.LONGEST and block.is_pair[i + size - 1]:
                    size += 1
                for k in range(1, size + 1):
                    f[lang, tuple(words[t].decode() for t in block.token[i : i + k])] += 1
    return f, n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.none() | st.text(alphabet="aB\t .,\n\x0b\r\x1cé日", max_size=40), st.sampled_from(["x", "y"])), max_size=5), st.integers(1, 12))
def test_blocks_count_all_windows(rows, size):
    old = c.HELD, c.SLICE
    c.HELD, c.SLICE = max(size, c.LONGEST), size
    try:
        found = windows_of(rows)
    finally:
        c.HELD, c.SLICE = old
    assert found == plain_counts(rows)


def rows():
    source = np.random.default_rng(3)
    words = ["the", "of", "New", "york", "times", "Äpfel", "日本", "a", "rare"]
    out = [(" ".join(source.choice(words, 40, p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.08, 0.02])), lang) for lang in ["en", "de", None] * 12]
    out += [("New York Times, of the day! new york times", "en")] * 15 + [("only here once", "xx")]
    return out + [(None, "en"), ("", None), (" \t . ,", "en"), ("x" * 100_000 + " the of", "en"), ("a b c d e f g. " * 3000, "long")]


@pytest.mark.parametrize("least, most, keep", [(10, 2000, 100), (3, 7, 60)])
def test_collocations(spark, least, most, keep):
    given_rows = rows()
    docs = spark.createDataFrame([(i, *row, "n", "w") for i, row in enumerate(given_rows)], SCHEMA).repartition(4)
    found = c.collocations(docs, least=least, most=most, keep=keep)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(row) for row in found.collect()) == plain(given_rows, least, most, keep)


def test_products_beyond_64_bits(spark):
    big = 10**15
    parts = [("x", "a b", 2, ["a", "b"], big), ("x", "a", 1, ["a"], 3 * big), ("x", "b", 1, ["b"], 7 * big)]
    counts = spark.createDataFrame(parts, "lang string, phrase string, size int, words array<string>, f long")
    assert c.scored(counts, spark.createDataFrame([("x", 10**17 + 1)], "lang string, n long")).first().score == 1000 * big * (10**17 + 1) // (21 * big * big)


def test_conditions_come_before_the_sums(spark):
    found = spark.createDataFrame([], "lang string, w1 string, w2 string, w3 string, w4 string, w5 string, n long")
    plan = c.phrase_counts(found)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.rindex("Filter") < plan.index("Expand")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 26), max_size=60), max_size=4))
def test_packed_codes(lists):
    least, batches = 3, []
    for codes in lists:
        rows = list(c._packed(np.array(codes, np.uint64)))
        batches.append(rows)
    rows = sorted((row for batch in batches for row in batch), key=lambda row: row[0])
    names = [field.split()[0] for field in c.PACKED.split(", ")]
    found = c._sums([c.to_batch(rows, names, c.arrow_types(c.PACKED))], least, 8) if rows else []
    marked = {row["range"] * 2**15 + i for batch in found for row in batch.to_pylist() for i in np.nonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little"))[0].tolist()}
    assert marked == {code >> 8 for code, times in Counter(code for codes in lists for code in codes).items() if times >= least}


def test_empty(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, None, None, "", "")], SCHEMA)).count() == 0
