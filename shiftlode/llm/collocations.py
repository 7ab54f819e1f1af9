"""Collocations: word sequences that stay together, counted from longest windows alone.

**Windows.** At every word the following words of its piece are set beside it, as in the columns of a window with leads: ``w1`` to
``w5``, null beyond the end of the piece (pieces end at ``.,;:!?`` and line ends). Only these rows are counted.
A phrase of k words occurs exactly where it is the head of a window, so Spark's ``ROLLUP`` over
(group, w1, ..., w5) sums the windows to the counts of all shorter phrases and to the number of words of the group;
there is no explosion for each length.

**Cut windows.** A phrase found ``least`` times has only words, neighbouring pairs and triples found as often. A first pass over the
texts adds those up by hashed codes of ``CODE_BITS`` bits: tasks send sorted codes, two bytes each, cut in ranges, and each range
is added up in one array of fixed size. The first ``BITS`` bits of the codes reaching ``least`` are
a bitmap of fixed size (2 MB), which all tasks get. Windows end before the first pair or triple outside of it, and words outside
count for the number of words only. Codes that collide let more windows through, never fewer, so all
counts that reach ``least`` are exact. The more words a corpus has, the more codes collide: beyond some 10 ** 11 words, ``code_bits`` should
rise with them (more ranges, not larger ones); else windows are whole, which costs more and changes nothing else.

**Scores.** Every cut of a candidate in two parts is looked up by two joins with the counts; the products are decimals
of 38 digits, so ``1000 * a * n`` may go up to 10 to the power of 38. Phrases inside a longer candidate that is
as frequent go; then each group keeps its best ``most``, cut in each task before the rows move.

Defined cases: a null or empty text has no words; a null group counts as ``UNKNOWN``; repeated rows count as often as they
occur; ties go by falling count, then by the bytes of the phrase; texts of any length are read as a stream of words, of which
``HELD`` are in memory at once (a single word is held whole); an empty table gives an empty table; other columns are ignored.
"""

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlode.llm.common import WordHashes, arrow_types, hashes_of, to_batch, values
from shiftlode.session import settle

LONGEST = 5
LEAST = 100
MOST = 2000
KEEP = 100  # percent of a phrase that a longer candidate has to cover to replace it
UNKNOWN = "und"
PARTS = 32
CODE_BITS, RANGE_BITS = 32, 23
BITS = 24
CODES = 1 << 22  # codes that a task adds up before it sends them
HELD = 1 << 18
SLICE = 1 << 20
LEADS = [f"w{i}" for i in range(1, LONGEST + 1)]

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_ENDS = b".,;:!?\n\x0b\x0c\r"
# Ends of pieces become a full stop, which no word holds; tabs become blanks.
_READ = bytes(ord(".") if b in _ENDS else 0x20 if b == 0x09 else b + 32 if b in _CAPITALS else b for b in range(0x100))
_BETWEEN = re.compile(rb"[ .]")
END = b"."


def token_slices(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text and ``END`` between pieces, slice by slice."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_READ)
    start = 0
    while start < len(data):
        found = _BETWEEN.search(data, start + SLICE)
        stop = found.start() if found else len(data)
        yield data[start:stop].replace(END, b" . ").split()
        start = stop


class Block:
    """Tokens of several texts one after another; windows start at all but the last ``LONGEST - 1`` of them."""

    def __init__(self, tokens: list[bytes], groups: list[int], names: list[str], known: WordHashes):
        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        self.words = coded.dictionary
        self.token = coded.indices.to_numpy()
        self.group, self.names = np.array(groups, np.int64), names
        self.starts = len(tokens) - LONGEST + 1
        spelt = self.words.to_pylist()
        self.is_word = np.array([word != END for word in spelt])[self.token]
        self.is_pair = self.is_word[:-1] & self.is_word[1:]
        salt = np.array([xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) for name in names], np.uint64)[self.group]
        code = hashes_of(spelt, known)[self.token]
        pair = _spread(code[:-1] ^ salt[:-1]) + code[1:]
        self.word_code, self.pair_code = _spread(code ^ salt), _spread(pair)  # of a token; of it and the next one
        self.triple_code = _spread(_spread(pair[:-1]) + code[2:])  # and the one after

    def codes(self) -> np.ndarray:
        """Of all words, pairs and triples that start in this block."""
        at = slice(self.starts)
        triple = self.is_pair[:-1] & self.is_pair[1:]
        parts = (self.word_code, self.is_word), (self.pair_code, self.is_pair), (self.triple_code, triple)
        return np.concatenate([code[at][real[at]] for code, real in parts])


def _spread(code: np.ndarray) -> np.ndarray:
    """Another order of the 64-bit numbers, in which every bit depends on all others."""
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        code = (code ^ (code >> np.uint64(31))) * np.uint64(factor)
    return code ^ (code >> np.uint64(29))


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    """The rows (text, group) of a task as blocks of tokens; every token starts a window of one block."""
    known, names = WordHashes(), {}
    tokens: list[bytes] = []
    groups: list[int] = []
    for batch in batches:
        for text, name in zip(values(batch.column(0)), values(batch.column(1))):
            group = names.setdefault(name, len(names))
            for words in itertools.chain(token_slices(text), [[END]]):
                tokens += words
                groups += itertools.repeat(group, len(words))
                if len(tokens) >= HELD:
                    yield Block(tokens, groups, list(names), known)
                    tokens, groups = tokens[1 - LONGEST :], groups[1 - LONGEST :]
    if tokens:
        tokens += [END] * (LONGEST - 1)
        groups += [groups[-1]] * (LONGEST - 1)
        yield Block(tokens, groups, list(names), known)


def _packed(codes: np.ndarray) -> Iterator[tuple]:
    """Rows (range, whether steps take four bytes, steps between the codes of a range, places of repeated codes, times they are repeated)."""
    codes, times = np.unique(codes, return_counts=True)
    part, place = codes >> np.uint64(RANGE_BITS), (codes & np.uint64((1 << RANGE_BITS) - 1)).astype(np.int64)
    starts = np.nonzero(np.diff(part, prepend=part[:1] - np.uint64(1)))[0].tolist() if len(codes) else []
    for start, stop in zip(starts, [*starts[1:], len(codes)]):
        steps, often = np.diff(place[start:stop], prepend=0), np.nonzero(times[start:stop] > 1)[0]
        wide = bool(steps.max() > 0xFFFF)
        kind = np.uint32 if wide else np.uint16
        extra = np.minimum(times[start:stop][often] - 1, 0xFFFFFFFF)
        yield int(part[start]), wide, steps.astype(kind).tobytes(), often.astype(np.uint32).tobytes(), extra.astype(np.uint32).tobytes()


PACKED = "range long, wide boolean, steps binary, places binary, extra binary"


def _sums(batches: Iterable[pa.RecordBatch], least: int, drop: int) -> Iterator[pa.RecordBatch]:
    """Bits of each range from its rows, which come together; one array of counts is held."""
    counts, current = np.zeros(1 << RANGE_BITS, np.int64), None

    def marks() -> pa.RecordBatch:
        bits = np.packbits((counts >= least).reshape(-1, 1 << drop).any(axis=1), bitorder="little").tobytes()
        return to_batch([(current, bits)], ["range", "bits"], [pa.int64(), pa.binary()])

    for batch in batches:
        for part, wide, *packed in zip(*[values(column) for column in batch.columns]):
            if part != current:
                if current is not None:
                    yield marks()
                    counts[:] = 0
                current = part
            steps, places, extra = (np.frombuffer(b, kind) for b, kind in zip(packed, (np.uint32 if wide else np.uint16, np.uint32, np.uint32)))
            code = np.cumsum(steps, dtype=np.int64)
            counts[code] += 1
            counts[code[places]] += extra
    if current is not None:
        yield marks()


def frequent_bits(texts: DataFrame, least: int = LEAST, code_bits: int = CODE_BITS) -> np.ndarray:
    """Bitmap, as bytes, of the first ``BITS`` bits of the codes found ``least`` times or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        names, types = [field.split()[0] for field in PACKED.split(", ")], arrow_types(PACKED)
        for block in blocks(batches):
            held.append(block.codes() >> np.uint64(64 - code_bits))
            n += len(held[-1])
            if n >= CODES:
                yield to_batch(list(_packed(np.concatenate(held))), names, types)
                held, n = [], 0
        yield to_batch(list(_packed(np.concatenate([np.zeros(0, np.uint64), *held]))), names, types)

    ranges = texts.mapInArrow(run, PACKED).repartition("range").sortWithinPartitions("range")
    # At most 2 MB of bits in all.
    rows = ranges.mapInArrow(lambda batches: _sums(batches, least, code_bits - BITS), "range long, bits binary").collect()
    size = (1 << (BITS + RANGE_BITS - code_bits)) // 8
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    for row in rows:
        bits[row.range * size : (row.range + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return bits


def _marked(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    bit = code >> np.uint64(64 - BITS)
    return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def windows(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """Longest windows ``w1`` to ``w5`` of all words of each ``lang``, cut by the bitmap, and how often (``n``) each comes in a block."""
    held = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            word = (block.is_word & _marked(held.value, block.word_code))[: block.starts]
            pair = block.is_pair & _marked(held.value, block.pair_code)
            triple = pair[:-1] & pair[1:] & _marked(held.value, block.triple_code)
            length = word.astype(np.int64)
            run_on = word & pair[: block.starts]
            for shift in range(LONGEST - 1):
                length += run_on
                run_on = run_on & triple[shift : shift + block.starts] if shift < LONGEST - 2 else run_on
            yield _rows(block, np.nonzero(length > 1)[0], length, None)
            # Windows of no or one word are added up here, by exact numbers of word and group.
            other = block.is_word[: block.starts] & (length < 2)
            kind = (block.token[: block.starts].astype(np.int64) * 2 + length) * len(block.names) + block.group[: block.starts]
            kind = np.where(length == 0, block.group[: block.starts] - len(block.names), kind)
            _, first, times = np.unique(kind[other], return_index=True, return_counts=True)
            yield _rows(block, np.nonzero(other)[0][first], length, times)

    schema = "lang string, " + ", ".join(f"{name} string" for name in LEADS) + ", n long"
    return texts.mapInArrow(run, schema)


def _rows(block: Block, start: np.ndarray, length: np.ndarray, times: np.ndarray | None) -> pa.RecordBatch:
    words = block.words.cast(pa.string())
    columns = [pa.array(block.names, pa.string()).take(pa.array(block.group[start]))]
    for shift in range(LONGEST):
        beyond = length[start] <= shift
        columns.append(words.take(pa.array(block.token[np.where(beyond, 0, start + shift)], mask=beyond)))
    columns.append(pa.array(np.ones(len(start), np.int64) if times is None else times))
    return pa.RecordBatch.from_arrays(columns, names=["lang", *LEADS, "n"])


def phrase_counts(found: DataFrame, least: int = LEAST) -> DataFrame:
    """Occurrences ``f`` of every phrase of ``size`` words found ``least`` times or more; size 0 has all words of the group.

    The conditions are on grouping columns only, so Spark tests them before it adds up.
    """
    level = F.grouping_id().alias("level")
    sums = found.rollup("lang", *LEADS).agg(level, F.sum("n").alias("f"))
    kept = F.col("level") == (1 << LONGEST) - 1
    for size, name in enumerate(LEADS, 1):
        kept |= (F.col("level") == (1 << (LONGEST - size)) - 1) & F.col(name).isNotNull()
    words = F.filter(F.array(*LEADS), lambda word: word.isNotNull()).alias("words")
    sums = sums.filter(kept).select("lang", words, "f").withColumn("size", F.size("words"))
    # Asked for by size, not by level: with a part in common the two conditions would become one that has to wait for the sums.
    sums = sums.filter((F.col("size") == 0) | (F.col("f") >= least))
    return sums.select("lang", F.concat_ws(" ", "words").alias("phrase"), "size", "words", "f")


def _joined(start: F.Column, size: F.Column) -> F.Column:
    return F.concat_ws(" ", F.slice("words", start, size))


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the lowest-scoring of their cuts; ``totals`` has the words of each group."""
    parts = counts.filter("size > 0").select("lang", "phrase", "f")
    cuts = counts.filter("size > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", _joined(F.lit(1), F.col("cut"))).withColumn("right", _joined(F.col("cut") + 1, F.col("size") - F.col("cut")))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    whole = {name: f"CAST({name} AS DECIMAL(19, 0))" for name in ("f", "l", "r", "n")}
    cuts = cuts.withColumn("score", F.expr(f"(1000BD * {whole['f']} * {whole['n']}) DIV ({whole['l']} * {whole['r']})"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    each = cuts.groupBy("lang", "phrase", "size", F.col("f").alias("a"), "n").agg(lowest)
    return each.select("lang", "phrase", "size", "a", "lowest.l", "lowest.r", "n", "lowest.score")


def covered(counts: DataFrame) -> DataFrame:
    """Count of the most frequent longer candidate around each phrase, as ``longer``."""
    spans = F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> concat_ws(' ', slice(words, i, k)))))"
    )
    inner = counts.filter("size > 2").select("lang", "f", F.explode(spans).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    df: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, most: int = MOST, keep: int = KEEP, code_bits: int = CODE_BITS
) -> DataFrame:
    """The best ``most`` phrases of each group (``lang``) with their counts, score and rank."""
    texts = df.select(F.col(text), F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN)))
    counts = settle(phrase_counts(windows(texts, frequent_bits(texts, least, code_bits)), least), "phrases")
    # One row per group, in a table of its own, so that Spark knows how small it is.
    totals = settle(counts.filter("size = 0").select("lang", F.col("f").alias("n")), "totals")
    rows = scored(counts, totals).join(covered(counts), ["lang", "phrase"], "left")
    rows = rows.filter(F.coalesce(100 * F.col("longer") < keep * F.col("a"), F.lit(True)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    # First the best of each part of a group, so that the task of a group gets at most PARTS * most rows.
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
