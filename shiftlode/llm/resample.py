"""Resampling by importance: documents drawn by how much their words look like a target collection.

**Features** of a text are its words and pairs of neighbouring words (A-Z lower-cased; a word is a run of digits,
letters a-z and anything beyond ASCII), each hashed to one of ``BUCKETS`` buckets by CRC-32. One pass over the
texts counts the buckets; the log-ratios of the two smoothed distributions are an array of
``BUCKETS`` whole numbers (**gains**, in thousandths). A second pass takes the mean gain of each text from that
array and adds Gumbel noise from a hash of the id, so that taking the largest scores is a draw
without replacement with odds by weight.

**Cutoff.** The scores are written once, with a number per row that tells repeated rows apart. The draw is the
first ``take`` rows by (score falling, id, number). Its last row is found by bisection with
numbers: each job counts the rows at or above ``FAN`` thresholds exactly and keeps the interval that holds the cutoff, first for
the score, then for the ids tied at it, then for the numbers of rows with that score and id. No rows are
sorted for it or sent to the driver, only ``FAN`` counts a job.

**Ranks.** The drawn rows alone are range-partitioned by the same order, sorted within partitions and written
with their place; the sizes of the partitions before (one number per partition) make it the rank.

Defined cases: a null or empty text has no features, weight 0 and is not drawn unless ``least_words`` is 0; ties
go to the smaller id, null ids last; rows with the same id and score are drawn in an arbitrary but fixed
order; a null id is hashed as the empty text; long texts are read in slices of ``SLICE`` bytes cut between words; an empty
table gives an empty table, an empty target gives gains from smoothing alone; other columns are ignored.
"""

import hashlib
import itertools
import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import arrow_types, to_batch, values
from shiftlode.session import settle

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
SHARE = 25  # percent of the documents with enough words
FAN = 32  # thresholds counted by one job
SLICE = 1 << 20
HELD = 1 << 16  # features that are held before they are counted

_WORD_BYTES = bytes(range(ord("0"), ord("9") + 1)) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0x80, 0x100))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Every byte that is in no word becomes a blank.
_READ = bytes(b if b in _WORD_BYTES else b + 32 if b in _CAPITALS else 0x20 for b in range(0x100))
_BLANK = re.compile(b" ")


def slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_READ)
    start = 0
    while start < len(data):
        end = _BLANK.search(data, start + SLICE)
        stop = end.start() if end else len(data)
        yield data[start:stop].split()
        start = stop


def feature_codes(text: str | None) -> Iterator[tuple[int, list[int]]]:
    """Number of words and CRC-32 of all features, slice by slice."""
    last: list[int] = []
    for words in slices(text):
        codes = list(map(crc32, words))
        # The checksum of a pair goes on from the one of its first word.
        heads = map(crc32, itertools.repeat(b" "), last + codes)
        pairs = map(crc32, words if last else words[1:], heads)
        found = len(words), codes + list(pairs)
        last = codes[-1:] or last
        yield found


def bucket_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of features per ``bucket`` over all texts, as ``n``; buckets without any are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(BUCKETS, np.int64), []
        for batch in batches:
            for value in values(batch.column(0)):
                for _, codes in feature_codes(value):
                    held += codes
                    if len(held) >= HELD:
                        total += np.bincount(np.array(held, np.int64) % BUCKETS, minlength=BUCKETS)
                        held = []
        total += np.bincount(np.array(held, np.int64) % BUCKETS, minlength=BUCKETS)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return df.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(df: DataFrame, text: str) -> np.ndarray:
    """At most ``BUCKETS`` rows come to the driver."""
    counts = np.zeros(BUCKETS, np.int64)
    for row in bucket_counts(df, text).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of the smoothed shares of each bucket, rounded down."""
    s_all, t_all = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def noise(key: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variable from a hash of the id, rounded down."""
    name = f"{seed}:{'' if key is None else key}"
    part = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((part + 0.5) / 4294967296)))


SCHEMA = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Features, weight and noisy score of every row."""
    names, types = [field.split()[0] for field in SCHEMA.split(", ")], arrow_types(SCHEMA)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, value in zip(values(batch.column(0)), values(batch.column(1))):
                words = features = total = 0
                for n, codes in feature_codes(value):
                    words += n
                    features += len(codes)
                    total += int(gain[np.array(codes, np.int64) % BUCKETS].sum())
                weight = total // features if features else 0
                rows.append((number, words, features, weight, weight + noise(number, seed)))
            yield to_batch(rows, names, types)

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def _first_rows(rows: DataFrame, column: str, take: int, falling: bool) -> tuple[int, int]:
    """The value of ``column`` at which ``take`` rows are reached, and how many rows come strictly before it."""
    order = -F.col(column) if falling else F.col(column)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    before = 0  # rows below ``low``
    while low < high:
        # Count the rows up to each of some thresholds in one job.
        steps = sorted({low + (high - low) * i // FAN for i in range(FAN)})
        counts = rows.agg(*[F.count_if(order <= step).alias(f"n{i}") for i, step in enumerate(steps)]).first()
        reached = next((i for i, n in enumerate(counts) if n >= take), len(steps))
        if reached:
            low, before = steps[reached - 1] + 1, counts[reached - 1]
        if reached < len(steps):
            high = steps[reached]
    return (-low if falling else low), before


def _cut(rows: DataFrame, take: int) -> F.Column:
    """Condition of the first ``take`` rows by score falling, id (nulls last) and row number; ``take`` is at most the number of rows."""
    score, before = _first_rows(rows, "score", take, falling=True)
    inside = F.col("score") > score
    tied, take = rows.filter(F.col("score") == score), take - before
    with_id = tied.filter("doc_id IS NOT NULL")
    known = with_id.count()
    if take <= known:
        key, before = _first_rows(with_id, "doc_id", take, falling=False)
        inside |= (F.col("score") == score) & (F.col("doc_id") < key)
        tied, take, same = with_id.filter(F.col("doc_id") == key), take - before, F.col("doc_id") == key
    else:
        inside |= (F.col("score") == score) & F.col("doc_id").isNotNull()
        tied, take, same = tied.filter("doc_id IS NULL"), take - known, F.col("doc_id").isNull()
    row, _ = _first_rows(tied, "row", take, falling=False)
    return F.coalesce(inside | ((F.col("score") == score) & same & (F.col("row") <= row)), F.lit(False))


def draw(scores: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with the ``rank`` of the rows that are drawn: ``share`` percent of those with enough words."""
    kept = settle(scores.withColumn("row", F.monotonically_increasing_id()), "scores")
    enough = kept.filter(F.col("n_words") >= least_words)
    take = share * enough.count() // 100
    if not take:
        return kept.select(*scores.columns, F.lit(None).cast("long").alias("rank"))
    chosen = (F.col("n_words") >= least_words) & _cut(enough, take)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    # Within a partition the made number counts rows from 0 in its lower 33 bits; above them is the partition.
    placed = settle(
        kept.filter(chosen).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "drawn",
    )
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    before = itertools.accumulate([row["count"] for row in sizes], initial=0)
    starts = scores.sparkSession.createDataFrame([(row.part, start) for row, start in zip(sizes, before)], "part long, start long")
    ranked = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    return ranked.select(*scores.columns, (F.col("start") + within + 1).alias("rank")).unionByName(
        kept.filter(~chosen).select(*scores.columns, F.lit(None).cast("long").alias("rank"))
    )


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """Weight, score and rank of every row of ``df``; the target's texts are in the column ``text`` too."""
    gain = gains(_counts(df, text), _counts(target, text))
    return draw(scored(df, gain, key, text), share)
