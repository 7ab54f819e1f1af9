"""Masked pseudo-likelihood: every token predicted from both sides by a window network.

**Tokens** are the words of a text, hashed to 64 bits once. The lowest bits are the bucket of a word, written as two bytes a
token; the counts of buckets are at most ``BUCKETS`` rows. Buckets are put in ``CLASSES * CELLS`` cells of about
equal mass by falling count, ``CELLS`` next to each other are a class, and

    log p(word | window) = log p(class | window) + log p(cell | class, window) + log p(bucket | cell) + log p(word | bucket)

The first two parts come from a network with two levels: the ``2 * SIDE`` neighbours (hashed to ``FEATURES`` rows, one table per
position) are added up, ``tanh``, softmax over the classes, and a softmax of each class over its cells. The
third is the smoothed share of the bucket in its cell. The fourth is the share of the word in its bucket, from the
counts of all distinct words, a grouped Spark table: words are told apart by 64 bits, not by buckets. The counts of at most ``FREQUENT`` words are
looked up in the tasks, those of all others are joined by word. So the window decides between cells, the counts within a cell.

**Training** is numpy inside tasks. In each round every task starts from the same parameters, goes through its
documents in small batches (every ``STRIDE``-th token of every document is a target, at another offset in each of
the ``STRIDE`` rounds, so that each token is a target once), and gives its parameters weighted by its targets. Spark adds them up chunk by chunk, salted first, so
what is gathered grows with the input but no task or driver ever holds more than a chunk of
each; the mean (about a megabyte) is the next round's start.

**Scores** are the sums over all tokens of a text. Only numbers move: (row, word, times) of the words that are not
frequent, and one sum a row.

Defined cases: a null or empty text has no tokens, log-likelihood 0 and no mean; neighbours beyond the ends of a text are
one special row; repeated rows get equal scores but for the last digits of single precision; an empty table gives an empty table; other columns
are ignored. Without any word in the corpus all tokens are equally likely.
"""

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import WordHashes, arrow_types, by_row, hashes_of, to_batch, values, words_of
from shiftlode.session import settle

BUCKETS = 1 << 16
FEATURES = 1 << 12
CLASSES, CELLS = 64, 32
SIDE = 2
WIDTH = 16
ROUNDS = 2
STRIDE = ROUNDS  # each token is a target in one round
BATCH = 2048
RATE, TABLE_RATE = 0.5, 0.3
PIECE = 1 << 12  # tokens that are scored at once
CHUNK = 1 << 14  # parameters that are added up as one row
SALT = 32
SMOOTH = 0.5
FREQUENT = 1 << 17  # words whose counts tasks hold
STEPS = 8  # parts of a power of two in the histogram that finds them
HELD = 1 << 20  # words whose counts are added up at once


def buckets_of(text: str | None, known: WordHashes) -> np.ndarray:
    return (hashes_of(words_of(text), known) % np.uint64(BUCKETS)).astype(np.int64)


class Vocabulary:
    """Kind (cell of a class) of every bucket, its log-share in the kind, and the class of every kind."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(BUCKETS), -counts))
        mass = counts[order] + SMOOTH
        before = np.cumsum(mass) - mass
        part = np.minimum((before / mass.sum() * CLASSES * CELLS).astype(np.int64), CLASSES * CELLS - 1)
        places, part = np.unique(part, return_inverse=True)  # a very frequent word may skip cells
        self.kind = np.empty(BUCKETS, np.int64)
        self.kind[order] = part
        total = np.bincount(part, mass)
        self.log_share = np.empty(BUCKETS)
        self.log_share[order] = np.log(mass / total[part])
        self.log_class = np.log(total / total.sum())
        self.group = np.unique(places // CELLS, return_inverse=True)[1]  # rising, so cells of a class are neighbours
        self.first = np.searchsorted(self.group, np.arange(self.group[-1] + 2))
        self.log_group = np.log(np.add.reduceat(total, self.first[:-1]) / total.sum())


def log_softmax(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of the chosen row of every column; rows at minus infinity take no part. Changes ``logits``, as the next does."""
    logits -= logits.max(axis=0)
    found = logits[chosen, np.arange(len(chosen))]
    return found - np.log(np.exp(logits, out=logits).sum(axis=0))


def softmax_error(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=0)
    error = np.exp(logits, out=logits)
    error /= error.sum(axis=0)
    error[chosen, np.arange(len(chosen))] -= 1
    return error


class Network:
    """Parameters as one float32 array; the layers are views of it."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        kinds, groups = len(vocabulary.log_class), len(vocabulary.log_group)
        self.group, self.first = vocabulary.group, vocabulary.first
        shapes = [(2 * SIDE, FEATURES, WIDTH), (WIDTH,), (WIDTH, groups), (groups,), (kinds, WIDTH), (kinds,)]
        sizes = [int(np.prod(shape)) for shape in shapes]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        layers = (part.reshape(shape) for part, shape in zip(parts, shapes))
        self.tables, self.bias, self.out, self.prior, self.inner, self.inner_prior = layers
        if flat is None:
            source = np.random.default_rng(11)
            self.tables[:] = source.normal(0, 0.1, self.tables.shape)
            self.out[:] = source.normal(0, 0.1, self.out.shape)
            self.prior[:] = vocabulary.log_group
            self.inner_prior[:] = vocabulary.log_class

    def hidden(self, window: np.ndarray) -> np.ndarray:
        """Hidden values of each target and a one, so that products add the priors too."""
        total = self.tables[0].take(window[:, 0], axis=0)
        for place in range(1, 2 * SIDE):
            total += self.tables[place].take(window[:, place], axis=0)
        total += self.bias
        own = np.ones((len(total), WIDTH + 1), np.float32)
        np.tanh(total, out=own[:, :WIDTH])
        return own

    def in_classes(self, window: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
        """Targets in the order of their classes: their places, windows, classes and cells in these."""
        order = np.argsort(self.group[kind].astype(np.uint16), kind="stable")
        group = self.group[kind[order]]
        return order, window[order], group, kind[order] - self.first[group]

    def by_class(self, group: np.ndarray) -> Iterator[tuple[slice, slice]]:
        """Targets (in the order of their classes) of each class, and its cells."""
        ends = np.searchsorted(group, np.arange(len(self.first))).tolist()
        first = self.first.tolist()
        return ((slice(*x), slice(*y)) for x, y in zip(itertools.pairwise(ends), itertools.pairwise(first)) if x[0] < x[1])

    def of_classes(self, own: np.ndarray) -> np.ndarray:
        """Logits of the classes, one column a target: sums over short columns are much faster than over short rows."""
        return np.concatenate([self.out, self.prior[None]]).T @ own.T

    def of_cells(self, own: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Logits of the cells of the class of each target, one column a target, minus infinity after the last cell."""
        inner = np.concatenate([self.inner, self.inner_prior[:, None]], axis=1)
        logits = np.full((int(np.diff(self.first).max()), len(group)), -np.inf, np.float32)
        for targets, cells in self.by_class(group):
            logits[: cells.stop - cells.start, targets] = inner[cells].dot(own[targets].T)
        return logits

    def log_probability(self, window: np.ndarray, kind: np.ndarray) -> np.ndarray:
        order, window, group, cell = self.in_classes(window, kind)
        own = self.hidden(window)
        found = np.empty(len(kind), np.float32)
        found[order] = log_softmax(self.of_classes(own), group) + log_softmax(self.of_cells(own, group), cell)
        return found

    def learn(self, window: np.ndarray, kind: np.ndarray, share: float = 1.0) -> None:
        """One step of gradient descent on a batch; ``share`` shortens the step of a small one."""
        _, window, group, cell = self.in_classes(window, kind)
        own = self.hidden(window)
        hidden = own[:, :WIDTH]
        error = softmax_error(self.of_classes(own), group)
        wrong = softmax_error(self.of_cells(own, group), cell)
        back, moved = np.empty((len(kind), WIDTH), np.float32), np.zeros((len(self.inner), WIDTH + 1), np.float32)
        for targets, cells in self.by_class(group):
            part = wrong[: cells.stop - cells.start, targets]
            part.T.dot(self.inner[cells], out=back[targets])
            part.dot(own[targets], out=moved[cells])
        times = np.bincount(group, minlength=len(self.first) - 1)
        pace = share * RATE / np.maximum(times, CELLS)  # few targets make a short step
        moved *= np.repeat(pace, np.diff(self.first)).astype(np.float32)[:, None]
        self.inner -= moved[:, :WIDTH]
        self.inner_prior -= moved[:, WIDTH]
        back += error.T @ self.out.T
        back *= 1 - hidden * hidden
        step = np.float32(share * RATE / len(kind))
        turned = step * (error @ own)
        self.out -= turned[:, :WIDTH].T
        self.prior -= turned[:, WIDTH]
        self.bias -= step * back.sum(axis=0)
        # Rows of frequent words get the mean of their gradients, so steps stay bounded. The tables of all positions go at once.
        rows = (window + np.arange(2 * SIDE) * FEATURES).astype(np.uint16).T.ravel()
        order = np.argsort(rows, kind="stable")
        rows, order = rows[order], order % len(kind)
        starts = np.concatenate([[0], 1 + np.nonzero(rows[1:] != rows[:-1])[0]])
        times = np.diff(starts, append=len(rows))
        tables, pace = self.tables.reshape(-1, WIDTH), np.float32(share * TABLE_RATE)
        back *= pace
        once, several = starts[times == 1], times > 1  # most rows occur once in a batch and need no sum
        tables[rows[once]] -= back.take(order[once], axis=0)
        held, often = np.repeat(several, times), times[several]
        if len(often):
            sums = np.add.reduceat(back.take(order[held], axis=0), np.cumsum(often) - often, axis=0)
            tables[rows[starts[several]]] -= sums / np.sqrt(often, dtype=np.float32)[:, None]


def windows(buckets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbours and buckets of the tokens of a text, piece by piece."""
    edge = np.zeros(SIDE, np.int64)
    padded = np.concatenate([edge, 1 + buckets % (FEATURES - 1), edge])
    for start in range(0, len(buckets), PIECE):
        size = min(PIECE, len(buckets) - start)
        places = [start + SIDE + shift for shift in range(-SIDE, SIDE + 1) if shift]
        yield np.stack([padded[p : p + size] for p in places], axis=1), buckets[start : start + size]


def encoded(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every text for the passes that follow, written: ``doc_id``, ``tokens`` (buckets, two bytes each), ``row`` (a
    number of its own), and its different ``words`` (eight bytes each, rising) with how many ``times`` (eight bytes) each occurs."""

    def step():
        known = WordHashes()
        rows = itertools.count(TaskContext.get().partitionId() << 40)

        def each(number, value):
            hashes = hashes_of(words_of(value), known)
            words, times = np.unique(hashes.view(np.int64), return_counts=True)
            buckets = (hashes % np.uint64(BUCKETS)).astype("<u2")
            return [(number, buckets.tobytes(), next(rows), words.astype("<i8").tobytes(), times.astype("<i8").tobytes())]

        return each

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return settle(by_row(rows, ["doc_id", "text"], step, "doc_id long, tokens binary, row long, words binary, times binary"), "tokens")


def count_words(tokens: DataFrame) -> DataFrame:
    """``word`` (64 bits) and ``n`` of all distinct words, written."""

    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        words, times = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(words)
        words = words[order]
        starts = np.nonzero(np.diff(words, prepend=words[0] - 1))[0]
        return pa.RecordBatch.from_arrays([pa.array(words[starts]), pa.array(np.add.reduceat(times[order], starts))], names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for words, times in zip(values(batch.column(0)), values(batch.column(1))):
                if words:
                    held.append((np.frombuffer(words, "<i8"), np.frombuffer(times, "<i8")))
                    size += len(held[-1][0])
                if size >= HELD:
                    yield added(held)
                    held, size = [], 0
        if held:
            yield added(held)

    found = tokens.select("words", "times").mapInArrow(run, "word long, n long")
    return settle(found.groupBy("word").agg(F.sum("n").alias("n")), "words")


def frequent_words(words: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` words, rising, and the logarithms of their counts: all above a count that a histogram gives."""
    level = F.floor(F.log2("n") * STEPS)
    sizes = sorted(((row["level"], row["count"]) for row in words.groupBy(level.alias("level")).count().collect()), reverse=True)
    total, least = 0, None
    for at, size in sizes:
        total += size
        if total > most:
            break
        least = at
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    found = words.filter(level >= least).toPandas()
    number, n = found["word"].to_numpy(np.int64), found["n"].to_numpy(np.float64)
    order = np.argsort(number)
    return number[order], np.log(n[order])


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``row``, ``word`` and ``times`` of the words of many texts at once, from ``row``, ``words`` and ``times`` of each."""

    def joined(held: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, words, times = zip(*held)
        sizes = [len(x) // 8 for x in words]
        return np.repeat(np.array(rows, np.int64), sizes), np.frombuffer(b"".join(words), "<i8"), np.frombuffer(b"".join(times), "<i8")

    for batch in batches:
        held, size = [], 0
        for row in zip(*[values(batch.column(i)) for i in range(3)]):
            held.append(row)
            size += len(row[1]) // 8
            if size >= HELD // 8:
                yield joined(held)
                held, size = [], 0
        if size:
            yield joined(held)


def other_words(tokens: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``row``, ``word``, ``times`` of the words of every text that are not frequent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in gathered(batches):
            other = ~known(frequent, held[1])[0]
            yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in held], names=["row", "word", "times"])

    return tokens.select("row", "words", "times").mapInArrow(run, "row long, word long, times long")


def known(frequent: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are frequent, and their places."""
    if not len(frequent):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    place = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return frequent[place] == words, place


def token_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(value, "<u2").astype(np.int64) for value in values(column))


def count_buckets(tokens: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts. At most BUCKETS rows come to the driver."""
    schema = "bucket long, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, size = np.zeros(BUCKETS, np.int64), [], 0
        for batch in batches:
            for value in token_arrays(batch.column(0)):
                held.append(value)
                size += len(held[-1])
                if size >= BUCKETS:
                    sums += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, size = [], 0
        if held:
            sums += np.bincount(np.concatenate(held), minlength=BUCKETS)
        found = np.nonzero(sums)[0]
        yield to_batch(list(zip(found.tolist(), sums[found].tolist())), ["bucket", "n"], arrow_types(schema))

    grouped = tokens.select("tokens").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS)
    counts[grouped["bucket"].to_numpy(np.int64)] = grouped["n"]
    return counts


PARTS = "chunk int, salt int, weight double, sums binary"


def train_task(texts: Iterable[np.ndarray], network: Network, vocabulary: Vocabulary, offset: int, stride: int = STRIDE) -> int:
    """Go through texts (arrays of buckets) in batches; returns the number of targets, all of them learnt."""
    held, size, total = [], 0, 0
    for tokens in texts:
        for window, target in windows(tokens):
            held.append((window[offset::stride], vocabulary.kind[target[offset::stride]]))
            size += len(held[-1][1])
            if size >= BATCH:
                window, kind = (np.concatenate(x) for x in zip(*held))
                network.learn(window, kind)
                total, held, size = total + size, [], 0
    if size:
        window, kind = (np.concatenate(x) for x in zip(*held))
        network.learn(window, kind, min(1.0, size / BATCH) if total else 1.0)
        total += size
    return total


def train(tokens: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Rounds of local training and averaging over all documents (:func:`encoded`); together they learn every token once."""
    network = Network(vocabulary)
    names, types = [field.split()[0] for field in PARTS.split(", ")], arrow_types(PARTS)
    for number in range(rounds):
        start = network.flat

        def local(batches: Iterable[pa.RecordBatch], start=start, offset=number) -> Iterator[pa.RecordBatch]:
            own = Network(vocabulary, start.copy())
            total = train_task((x for batch in batches for x in token_arrays(batch.column(0))), own, vocabulary, offset, rounds)
            salt = TaskContext.get().partitionId() % SALT
            if total:
                moved = (own.flat - start) * np.float64(total)
                rows = [(at // CHUNK, salt, float(total), moved[at : at + CHUNK].tobytes()) for at in range(0, len(moved), CHUNK)]
                yield to_batch(rows, names, types)

        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[float, np.ndarray]] = {}
            for batch in batches:
                for chunk, weight, data in zip(*[values(batch.column(i)) for i in (0, 2, 3)]):
                    old = sums.get(chunk, (0.0, 0.0))
                    sums[chunk] = old[0] + weight, old[1] + np.frombuffer(data)
            yield to_batch([(chunk, 0, w, s.tobytes()) for chunk, (w, s) in sorted(sums.items())], names, types)

        parts = tokens.select("tokens").mapInArrow(local, PARTS)
        parts = parts.repartition("chunk", "salt").sortWithinPartitions("chunk", "salt", "weight", "sums").mapInArrow(add, PARTS)
        parts = parts.repartition("chunk").sortWithinPartitions("chunk", "weight", "sums").mapInArrow(add, PARTS)
        flat = start.astype(np.float64)
        for row in parts.collect():  # one row per chunk of the parameters
            sums = np.frombuffer(row["sums"])
            flat[row["chunk"] * CHUNK :][: len(sums)] += sums / row["weight"]
        network = Network(vocabulary, flat.astype(np.float32))
    return network


def score_texts(texts: Iterable[np.ndarray], network: Network, vocabulary: Vocabulary) -> Iterator[tuple[int, float]]:
    """Tokens and log-likelihood of every text, in order; short texts share a matrix product."""
    held, owners, size = [], [], 0

    def flush() -> list[tuple[int, float]]:
        window, target = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros((0, 2 * SIDE), np.int64), np.zeros(0, np.int64))
        logs = np.zeros(len(target))
        for at in range(0, len(target), PIECE):
            part = slice(at, at + PIECE)
            logs[part] = network.log_probability(window[part], vocabulary.kind[target[part]]) + vocabulary.log_share[target[part]]
        ends = np.cumsum(owners, dtype=np.int64).tolist()
        return [(n, float(logs[end - n : end].sum())) for n, end in zip(owners, ends)]

    for tokens in texts:
        if len(tokens) > 32 * PIECE:  # a very long text goes alone, piece by piece
            yield from flush()
            held, owners, size = [], [], 0
            parts = [network.log_probability(w, vocabulary.kind[t]).sum(dtype=np.float64) + vocabulary.log_share[t].sum() for w, t in windows(tokens)]
            yield len(tokens), float(sum(parts))
            continue
        held.extend(windows(tokens))
        owners.append(len(tokens))
        size += len(tokens)
        if size >= 4 * PIECE or len(owners) >= 4096:
            yield from flush()
            held, owners, size = [], [], 0
    yield from flush()


SCORES = "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double"


def score(tokens: DataFrame, network: Network, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """Pseudo-log-likelihood of the buckets of every text; with ``key`` "row" that number too."""
    schema = SCORES if key == "doc_id" else f"{SCORES}, {key} long"
    names, types = [field.split()[0] for field in schema.split(", ")], arrow_types(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = score_texts(token_arrays(batch.column(1)), network, vocabulary)
            keys = zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns) if i != 1])
            rows = [(own[0], n, total, total / n if n else None, *own[1:]) for own, (n, total) in zip(keys, scored)]
            yield to_batch(rows, names, types)

    return tokens.select("doc_id", "tokens", *([] if key == "doc_id" else [key])).mapInArrow(run, schema)


def word_shares(tokens: DataFrame, counts: np.ndarray) -> DataFrame:
    """``row`` and ``share``: the sum of log p(word | bucket) over all tokens of a text that has any."""
    words = count_words(tokens)
    frequent, logs = frequent_words(words)
    log_bucket = np.log(np.maximum(counts, 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, times in gathered(batches):
            found, place = known(frequent, words)
            logs_of = np.where(found, logs[place], 0.0) if len(logs) else 0.0
            starts = np.nonzero(np.diff(rows, prepend=-1))[0]
            sums = np.add.reduceat((logs_of - log_bucket[words % BUCKETS]) * times, starts)
            yield pa.RecordBatch.from_arrays([pa.array(rows[starts]), pa.array(sums)], names=["row", "share"])

    here = tokens.select("row", "words", "times").mapInArrow(run, "row long, share double")
    met = other_words(tokens, frequent).join(words, "word").select("row", (F.col("times") * F.log("n")).alias("share"))
    return here.unionByName(met).groupBy("row").agg(F.sum("share").alias("share"))


def pseudo_likelihood(df: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Count, train and score on the same documents. Counting and training run at once."""
    tokens = encoded(df, key, text)
    counts = count_buckets(tokens)
    vocabulary = Vocabulary(counts)
    scored = score(tokens, train(tokens, vocabulary, rounds), vocabulary, "row")
    total = F.col("log_likelihood") + F.coalesce("share", F.lit(0.0))
    return scored.join(word_shares(tokens, counts), "row", "left").select(
        F.col("doc_id").alias(key), "n_tokens", total.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood")
    )
