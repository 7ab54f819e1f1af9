"""Token ids in patched frame-of-reference blocks.

**Format.** A segment holds whole documents, at least one, up to about ``SEGMENT`` ids. Its
payload is little-endian::

    magic 'PFB1' | ids u64 | blocks u32 | starts u64 x blocks | blocks
    block: minimum u32 | width u8 | 0 u8 | exceptions u16 | packed u32 x 32 x width
           | positions u16 x exceptions | differences u32 x exceptions

A block has 1024 ids. The block minimum is subtracted; ``width`` is the number of bits that
holds the given percentile of the differences; larger differences are exceptions and patched
over the packed ones. The differences are packed in 32 lanes: id ``32 * g + lane`` is the
``g``-th value of its lane. ``starts`` gives the place of every block, so that a range of ids
is read without the others (:func:`unpack_range`).

Segments are rows of a Parquet table in the shared folder (``part``, ``seq``, document ids and
lengths, payload). That way the files are committed by Spark, survive lost executors, and need no
store that Python can open.

**Writing** sorts the documents by range partitions of the id, so that order over parts,
segments and documents is the ascending order of ids (null first; equal ids by text). The
texts move once; each task encodes and packs its range. **Reading** unpacks segments and adds
the number of ids in earlier parts, a table with one row per part.

Defined cases: a null or empty text has only the end id; repeated rows are all kept; an empty
table gives no files' rows and an empty result; other columns are ignored.
"""

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftlode.llm.bpe import byte_letters
from shiftlode.llm.common import arrow_types, to_batch, values
from shiftlode.session import new_path

MAGIC = b"PFB1"
LANES, DEPTH = 32, 32
BLOCK = LANES * DEPTH
PERCENTILE = 0.9
SEGMENT = 1 << 20
HEADER = struct.Struct("<4sQI")
CACHED_WORDS = 600_000
CACHED_LENGTH = 64
POWERS = np.array([1 << k for k in range(33)], np.uint64)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Ids (below 2**32) to a payload."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return HEADER.pack(MAGIC, 0, 0)
    full = np.concatenate([ids.astype(np.uint32), np.full(count * BLOCK - len(ids), ids[-1], np.uint32)])
    blocks = full.reshape(count, BLOCK)
    low = blocks.min(axis=1)
    difference = blocks - low[:, None]
    kth = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    chosen = np.partition(difference, kth, axis=1)[:, kth]
    width = np.searchsorted(POWERS, chosen.astype(np.uint64), side="right")
    limit = POWERS[width]
    over = difference >= limit[:, None]
    rows, places = np.nonzero(over)
    extra = difference[rows, places]
    bounds = np.searchsorted(rows, np.arange(count + 1))
    parts: list[bytes] = [b""] * count
    for bits in np.unique(width):
        chosen_rows = np.nonzero(width == bits)[0]
        words = _pack_lanes(difference[chosen_rows] & np.uint32((1 << int(bits)) - 1), int(bits))
        for row, data in zip(chosen_rows, words):
            first, last = bounds[row], bounds[row + 1]
            parts[row] = b"".join((
                struct.pack("<IBBH", low[row], bits, 0, last - first),
                data.tobytes(),
                places[first:last].astype("<u2").tobytes(),
                extra[first:last].astype("<u4").tobytes(),
            ))
    base = HEADER.size + 8 * count
    starts = base + np.concatenate([[0], np.cumsum([len(part) for part in parts[:-1]], dtype=np.int64)])
    return HEADER.pack(MAGIC, len(ids), count) + starts.astype("<u8").tobytes() + b"".join(parts)


def _pack_lanes(block: np.ndarray, bits: int) -> np.ndarray:
    value = block.reshape(-1, DEPTH, LANES)
    words = np.zeros((len(block), bits, LANES), "<u4")
    for depth in range(DEPTH if bits else 0):
        word, shift = divmod(depth * bits, 32)
        words[:, word] |= value[:, depth] << np.uint32(shift)
        if shift + bits > 32:
            words[:, word + 1] |= value[:, depth] >> np.uint32(32 - shift)
    return words


def _unpack_lanes(words: np.ndarray, bits: int) -> np.ndarray:
    value = np.zeros((len(words), DEPTH, LANES), np.uint32)
    mask = np.uint32((1 << bits) - 1)
    for depth in range(DEPTH if bits else 0):
        word, shift = divmod(depth * bits, 32)
        part = words[:, word] >> np.uint32(shift)
        if shift + bits > 32:
            part = part | (words[:, word + 1] << np.uint32(32 - shift))
        value[:, depth] = part & mask
    return value.reshape(len(words), BLOCK)


def unpack_range(payload: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``stop`` of a payload; only their blocks are read."""
    magic, total, count = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block file")
    stop = total if stop is None else min(stop, total)
    if first >= stop:
        return np.zeros(0, np.uint32)
    begin, end = first // BLOCK, -(-stop // BLOCK)
    starts = np.frombuffer(payload, "<u8", count, HEADER.size)[begin:end].tolist()
    heads = [struct.unpack_from("<IBBH", payload, start) for start in starts]
    width = np.array([head[1] for head in heads])
    out = np.empty((end - begin, BLOCK), np.uint32)
    for bits in np.unique(width).tolist():
        rows = np.nonzero(width == bits)[0]
        words = np.stack([np.frombuffer(payload, "<u4", bits * LANES, starts[row] + 8) for row in rows])
        out[rows] = _unpack_lanes(words.reshape(len(rows), bits, LANES), bits)
    for row, (start, head) in enumerate(zip(starts, heads)):
        if head[3]:
            at = start + 8 + 4 * LANES * head[1]
            place = np.frombuffer(payload, "<u2", head[3], at)
            out[row, place] = np.frombuffer(payload, "<u4", head[3], at + 2 * head[3])
    out += np.array([head[0] for head in heads], np.uint32)[:, None]
    return out.reshape(-1)[first - begin * BLOCK : stop - begin * BLOCK]


# The split pattern of the vocabulary, said for letters, digits and white space of Latin-1.
_LETTER, _DIGIT, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+")


class WordEncoder:
    """The tokenizers library, remembering the ids of short words.

    The vocabulary drops white space and never merges over it, and none of its special tokens
    contains any, so a text has the ids of its runs between blanks in order. Texts of Latin-1 without
    a special token are cut further, into the words of the split pattern in lower case: there
    are fewer different ones, and they go to the merges of the library at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.merges = self.library.model.tokenize
        letter = {byte: mark for mark, byte in byte_letters().items()}
        self.marks = {code: "".join(letter[byte] for byte in chr(code).encode()) for code in range(256)}
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> tuple[bool, list[str]]:
        """Parts of a text whose ids follow one another; whether they are words of the split pattern."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False, text.replace("\n", " ").split(" ")
        if any(token in text for token in self.special):
            return False, text.replace("\n", " ").split(" ")
        return True, LATIN.findall(text.lower())

    def new(self, order: list[str], split: bool) -> list[list[int]]:
        if split:
            return [[token.id for token in self.merges(word.translate(self.marks))] for word in order]
        return [encoded.ids for encoded in self.library.encode_batch_fast(order, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        split, words = self.words(text)
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > CACHED_WORDS:
            self.known.clear()
            missing = set(words)
        order = list(missing)
        for word, new in zip(order, self.new(order, split)):
            self.known[word] = struct.pack(f"<{len(new)}I", *new)
        ids = b"".join(map(self.known.__getitem__, words))
        for word in order:
            if len(word) > CACHED_LENGTH:
                del self.known[word]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        return ids


@functools.lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker."""
    return WordEncoder(path)


SEGMENTS = "part int, seq int, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"
DOCUMENTS = "part int, seq int, place int, doc_id long, start long, n_tokens long, ids_crc32 long"


def write_blocks(
    df: DataFrame, path: str, end_id: int, target: str, key: str = "doc_id", text: str = "text",
    percentile: float = PERCENTILE, segment_ids: int = SEGMENT,
) -> None:
    """Encode ``text``, append ``end_id`` and write segments in ascending order of ``key``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [field.split()[0] for field in SEGMENTS.split(", ")], arrow_types(SEGMENTS)
        encode, part, seq = word_encoder(path).encode, TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        numbers: list = []
        parts: list[bytes] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = (part, seq, len(ids), numbers, [len(x) // 4 for x in parts], pack(ids, percentile))
            return to_batch([row], names, types)

        for batch in batches:
            for number, value in zip(values(batch.column(0)), values(batch.column(1))):
                numbers.append(number)
                parts.append(encode(value or "") + end)
                size += len(parts[-1]) // 4
                if size >= segment_ids:
                    yield segment()
                    numbers, parts, size, seq = [], [], 0, seq + 1
        if parts:
            yield segment()

    rows = df.select(F.col(key).cast("long").alias(key), F.col(text), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    # Rows with one id are ordered by hash, equal rows by number, so that neither has to lie in one range.
    order = [F.col(key), F.col("_hash"), F.col("_row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, text)
    ranged.mapInArrow(run, SEGMENTS).write.parquet(target)


def read_blocks(spark: SparkSession, target: str) -> DataFrame:
    """Documents of the segments: place in the order, start, number and checksum of the ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [field.split()[0] for field in DOCUMENTS.split(", ")], arrow_types(DOCUMENTS)
        for batch in batches:
            for part, seq, total, numbers, lengths, payload in zip(*[values(batch.column(i)) for i in range(6)]):
                ids, out, start = unpack_range(payload).astype("<u4"), [], 0
                if len(ids) != total:
                    raise ValueError(f"segment {part}/{seq} has {len(ids)} of {total} ids")
                for place, (number, length) in enumerate(zip(numbers, lengths)):
                    check = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((part, seq, place, number, start, length, check))
                    start += length
                yield to_batch(out, names, types)

    segments = spark.read.parquet(target)
    within = Window.partitionBy("part").orderBy("seq")
    before = segments.select(
        "part", "seq", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("_before")
    )
    # One row per write task comes together here.
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    base = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_base"))
    offsets = before.join(base, "part").select("part", "seq", (F.col("_before") + F.col("_base")).alias("_offset"))
    documents = segments.select(*[field.split()[0] for field in SEGMENTS.split(", ")]).mapInArrow(run, DOCUMENTS)
    return documents.join(offsets, ["part", "seq"]).withColumn("start", F.col("start") + F.col("_offset")).drop("_offset")


def blocks_round_trip(
    df: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", segment_ids: int = SEGMENT
) -> DataFrame:
    """Write the segments to the shared folder and give the documents read back from them."""
    target = new_path(df.sparkSession, "blocks")
    write_blocks(df, path, end_id, target, key, text, segment_ids=segment_ids)
    return read_blocks(df.sparkSession, target).select(
        F.col("doc_id").alias(key), "start", "n_tokens", "ids_crc32"
    )
