"""BPE against the tokenizers library, texts with every awkward case."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shiftlode.llm.bpe import BLOCK, SLICE, Decoder, Encoder, MergeList, Transducer, bpe_decode, bpe_digest, bpe_encode

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MERGES = MergeList(PATH)
ENCODER = Encoder(MERGES)

TEXTS = [
    "",
    " ",
    "Hello, world's end.\n\n  It'll do\t\tnow ",
    "a<|endoftext|>b <|endoftext|>",
    "naïve Ünïcödé – 漢字 🙂 é  x y \x1c z",
    "ab" * 9000,
    "a" * 20_000 + " " * 9000 + "b" + "\n" * 5000 + "!" * 9000,
    "word " * 20_000,
    "é" * 12_000 + "'s 12345" * 300,
]


def tokens(text):
    return [number for piece in ENCODER.pieces(text) for number in piece]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_tokens_equal_the_library(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert tokens(text) == expected
    decoder = Decoder(MERGES)
    assert "".join(decoder.push([x]) for x in expected) + decoder.finish() == LIBRARY.decode(
        expected, skip_special_tokens=False
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'strevmdl.,!aéß1２\x1f  "), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60))
def test_random_texts(text):
    assert tokens(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=900), st.integers(1, 40))
def test_transducer_emits_only_final_tokens(data, step):
    """With the smallest buffer the tokens are those of the whole run."""
    data = bytes(97 + byte % 5 for byte in data)
    transducer = Transducer(MERGES)
    transducer.full = MERGES.lookahead + MERGES.longest
    out = []
    for at in range(0, len(data), step):
        out += transducer.push(data[at : at + step])
        assert len(transducer.buffer) < transducer.full + step
    out += transducer.finish()
    assert out == MERGES.merged([MERGES.first[byte] for byte in data])


def test_lookahead_is_bounded():
    assert 0 < MERGES.lookahead < BLOCK


def test_invalid_bytes_become_replacement_characters():
    ids = [MERGES.first[0xE6], MERGES.first[0xBC], MERGES.first[0x41], MERGES.first[0xFF]]
    decoder = Decoder(MERGES)
    assert decoder.push(ids) + decoder.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "abc def", None), (2, TEXTS[4], "x"), (2, TEXTS[4], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, bpe_digest(df, PATH).collect()), key=str)
    expected = []
    for number, text, _ in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.append((number, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(expected, key=str)
    round_trip = bpe_decode(bpe_encode(df, PATH), PATH)
    assert sorted(map(str, round_trip.collect())) == sorted(map(str, df.fillna("").select("doc_id", "text").collect()))
    assert bpe_digest(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("unit", ["漢字。", "ab\n", "x'll'", "1a\t\t", "don't  'r", "é" * 50 + "!!"])
def test_slices_cut_words_nowhere(unit):
    for pad in range(4):
        text = "'" * pad + unit * (3 * SLICE // len(unit))
        assert tokens(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_all_words_go_through_the_transducer_and_memory_is_bounded(monkeypatch):
    pushed, held, lists = [0], [0], [0]
    push, known = Transducer.push, Encoder._known

    def counted(self, data):
        pushed[0] += len(data)
        yield from push(self, data)
        held[0] = max(held[0], len(self.buffer))

    def noted(self, words):
        lists[0] = max(lists[0], sum(map(len, words)))
        return known(self, words)

    monkeypatch.setattr(Transducer, "push", counted)
    monkeypatch.setattr(Encoder, "_known", noted)
    own = Encoder(MERGES)
    small = "every word, once: über 漢字"
    assert [x for piece in own.pieces(small) for x in piece] == LIBRARY.encode(small, add_special_tokens=False).ids
    assert pushed[0] == len(small.encode())  # no byte takes another way
    for text in ("漢字。" * 1_700_000, "ab" * 150_000 + "\n" * 40_000):
        assert max(map(len, own.pieces(text))) <= 4 * SLICE
    assert lists[0] <= SLICE and held[0] < BLOCK * 5 + MERGES.lookahead + MERGES.longest
