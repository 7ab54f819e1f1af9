"""Secrets in texts: three patterns, and a character network that finds more of their kind.

**Base findings** come from fixed patterns over whole texts: assignments to names like password or token, access
keys, long lower-case hex numbers.

**Candidates** are all maximal runs of letters, digits and ``+/_=-`` with a digit and ``SHORT`` characters or more, or with ``LONG`` or more. Every
candidate is judged with ``SIDE`` characters of context on both sides. The network is a convolution over
characters in numpy (``WIDTH`` characters wide, ``FILTERS`` filters; characters of the candidate and of its context have
different weights), pooled by maximum and by mean, and one hidden layer. Candidates longer
than ``WINDOW`` characters are read in overlapping windows, the highest score counts, in training as in the scan.

**Training.** Labelled findings are the candidates of all documents, whole: those that a pattern found are secrets, the others are not;
copies of a finding with equal context count once. Secrets are also shown with
the context of an ordinary candidate, so that the value alone can tell. Findings are dealt by hash over shards of about ``SHARD``, or of
about ``WINDOWS`` windows if that makes more; in each of the ``EPOCHS`` epochs, however many shards there are, every shard trains the
common network on all its findings that are not held out, and the networks of the shards are averaged. The
larger kind weighs as much as the smaller. Findings whose value
hashes to 0 of ``FOLDS`` are held out: on all of them the outputs are calibrated to probabilities (a logistic curve), and the threshold is the highest at which at least
``RECALL`` of the held-out secrets, and as many of those with foreign context, are found, but never below ``LOWEST``. Candidates at or above
it that touch no base finding are added as ``network``; base findings always stay.

Defined cases: a null or empty text has no findings; without labelled findings of both kinds, held out and not, nothing is added; repeated
rows get equal findings; findings are ordered by start, then by kind as in ``KINDS``; texts are
scanned whole, a finding of any length is kept whole; an empty table gives an empty table; other columns are ignored.
"""

import copy
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import SEND, by_group, by_row, values
from shiftlode.operators.selection import values_at
from shiftlode.session import settle

KINDS = ["assign", "access", "hex", "network"]
SHORT, LONG = 8, 20
SIDE = 24
WINDOW = 128
WIDTH, FILTERS, HIDDEN = 5, 16, 16
SHARD = 4096
WINDOWS = 1 << 18
FOLDS = 4
RECALL = 0.98
LOWEST = 0.9
EPOCHS, BATCH, RATE = 12, 64, 0.01
NEWTON = 30
FIXED = float(1 << 32)  # sums are of whole parts of this, so that their order does not matter
SEED = 7
PIECE = 256  # windows that the network reads at once

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]
LEAST_VALUE = 6
# Runs below the least length fail whole: no part of a run is longer than the run.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(
    rf"(?<![A-Za-z0-9+/_=-])(?:(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{{{SHORT},}}|[A-Za-z+/_=-]{{{LONG},}})"
)
# Printable ASCII, then one number for all else; twice, for context and candidate; then the padding.
LETTERS = 96
PAD = 2 * LETTERS


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all matches of the patterns, in order."""
    lowered = text.lower()  # most texts hold none of the names, which is quickly seen
    named = any(name in lowered for name in NAMES)
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE] if named else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether a base finding touches it) of all candidates, in order."""
    reach, next_base, ordered = 0, 0, sorted((start, end) for start, _, end in base)
    for match in CANDIDATE.finditer(text):
        while next_base < len(ordered) and ordered[next_base][0] < match.end():
            reach = max(reach, ordered[next_base][1])
            next_base += 1
        yield match.start(), match.end(), reach > match.start()


def window_ids(before: str, value: str, after: str) -> np.ndarray:
    """Windows (rows) of ``WINDOW`` numbers over a candidate and its context: a view, a byte a character."""
    codes = np.frombuffer((before + value + after).encode("utf-32-le", "surrogatepass"), np.uint32) - np.uint32(32)
    steps = max(0, -(-(len(codes) - WINDOW) // (WINDOW // 2)))
    out = np.full(steps * (WINDOW // 2) + WINDOW, PAD, np.uint8)
    out[: len(codes)] = np.minimum(codes, LETTERS - 1)  # below 32 the subtraction wraps
    out[len(before) : len(before) + len(value)] += LETTERS
    return sliding_window_view(out, WINDOW)[:: WINDOW // 2] if steps else out[None]


class Network:
    """Convolution over characters, two poolings, a hidden layer; one output per window."""

    def __init__(self, seed: int = SEED):
        source = np.random.default_rng(seed)
        self.parts = [
            source.normal(0, 0.1, (WIDTH, PAD + 1, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            source.normal(0, 0.3, (2 * FILTERS, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            source.normal(0, 0.3, HIDDEN).astype(np.float32),
            np.zeros(1, np.float32),
        ]

    def _forward(self, ids: np.ndarray) -> tuple:
        kernel, bias, inner, inner_bias, out, out_bias = self.parts
        places = ids.shape[1] - WIDTH + 1
        signal = np.zeros((len(ids), places, FILTERS), np.float32) + bias
        for shift in range(WIDTH):
            signal += kernel[shift][ids[:, shift : shift + places]]
        signal = np.maximum(signal, 0) * (ids[:, :places] != PAD)[:, :, None]
        size = np.maximum((ids[:, :places] != PAD).sum(axis=1), 1)[:, None]
        highest = signal.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(signal, highest[:, None], 1)[:, 0], signal.sum(axis=1) / size], axis=1)
        hidden = np.tanh(pooled @ inner + inner_bias)
        return signal, size, highest, pooled, hidden, hidden @ out + out_bias[0]

    def score(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.float32), *[self._forward(ids[i : i + PIECE])[-1] for i in range(0, len(ids), PIECE)]])

    def gradient(self, ids: np.ndarray, label: np.ndarray, weight: np.ndarray | float = 1.0) -> list[np.ndarray]:
        """Of the mean of the weighted logistic losses."""
        kernel, _, inner, _, out, _ = self.parts
        signal, size, highest, pooled, hidden, score = self._forward(ids)
        error = (weight * (1 / (1 + np.exp(-score)) - label) / len(ids)).astype(np.float32)
        back = error[:, None] * out * (1 - hidden**2)
        to_pool = back @ inner.T
        to_signal = np.broadcast_to((to_pool[:, FILTERS:] / size)[:, None], signal.shape).copy()
        rows, filters = np.arange(len(ids))[:, None], np.arange(FILTERS)
        to_signal[rows, highest, filters] += to_pool[:, :FILTERS]
        to_signal *= signal > 0
        to_kernel, flat = np.zeros_like(kernel), to_signal.reshape(-1, FILTERS)
        for shift in range(WIDTH):
            letter = ids[:, shift : shift + signal.shape[1]].ravel()
            order = np.argsort(letter, kind="stable")
            seen, first = np.unique(letter[order], return_index=True)
            to_kernel[shift, seen] = np.add.reduceat(flat[order], first, axis=0)
        return [to_kernel, flat.sum(axis=0), pooled.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]

    def highest(self, windows: np.ndarray) -> np.ndarray:
        """The window with the highest score."""
        return windows[self.score(windows).argmax() if len(windows) > 1 else 0]

    def train(self, windows: Sequence[np.ndarray], label: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Steps with momentum and scaled by the size of past gradients, over shuffled batches.

        ``windows`` has those of one finding after the other; the one that scores highest at its step is the one that learns.
        """
        source = np.random.default_rng(seed)
        mean, square = ([np.zeros_like(part) for part in self.parts] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = source.permutation(len(windows))
            for start in range(0, len(order), BATCH):
                step += 1
                some = order[start : start + BATCH]
                ids = np.stack([self.highest(windows[place]) for place in some])
                for part, m, s, g in zip(self.parts, mean, square, self.gradient(ids, label[some], weight[some])):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    part -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)


class Detector:
    """Network, logistic calibration (slope, offset) and threshold on the probability."""

    def __init__(self, network: Network, slope: float, offset: float, threshold: float):
        self.network, self.slope, self.offset, self.threshold = network, slope, offset, threshold

    def probability(self, items: list[tuple[str, str, str]]) -> np.ndarray:
        """Of (before, value, after); the highest of the windows of each."""
        found, held, owner = np.full(len(items), -np.inf), [], []

        def flush() -> None:
            np.maximum.at(found, owner, self.network.score(np.concatenate(held)))
            held.clear(), owner.clear()

        for number, item in enumerate(items):
            windows = window_ids(*item)
            for start in range(0, len(windows), PIECE):
                held.append(windows[start : start + PIECE])
                owner.extend([number] * len(held[-1]))
                if len(owner) >= PIECE:
                    flush()
        if owner:
            flush()
        return self.chance(found)

    def chance(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -50, 50)))


def logistic_fit(scores: DataFrame, rounds: int = NEWTON) -> tuple[float, float]:
    """Slope and offset of the probability as a function of ``score``, by Newton steps; a small penalty keeps them finite.

    Five sums per step come to the driver.
    """
    at = np.array([1.0, 0.0])
    x = F.col("score")
    for _ in range(rounds):
        z = F.least(F.greatest(x * F.lit(float(at[0])) + F.lit(float(at[1])), F.lit(-30.0)), F.lit(30.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        miss, bend = F.col("weight") * (p - F.col("label")), F.col("weight") * p * (F.lit(1.0) - p)
        terms = [miss * x, miss, bend * x * x, bend * x, bend]
        sums = [float(part) / FIXED for part in scores.agg(*[F.sum((term * FIXED).cast("decimal(28,0)")) for term in terms]).first()]
        bends = np.array([[sums[2], sums[3]], [sums[3], sums[4]]])
        move = np.linalg.solve(bends + 1e-2 * np.eye(2), np.array(sums[:2]) + 1e-2 * at)
        at = at - move
        if np.abs(move).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _context(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - SIDE) : start], text[start:end], text[end : end + SIDE]


def labelled_findings(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Candidates (before, value, after) of all documents and whether a pattern found them, each once."""

    def step() -> Callable:
        def run(value: str | None) -> Iterator[tuple]:
            if value:
                for start, end, known in candidates(value, base_findings(value)):
                    yield *_context(value, start, end), int(known)

        return run

    return by_row(df, [text], step, "before string, value string, after string, known long").distinct()


Items = tuple[list[tuple[str, str, str]], np.ndarray, np.ndarray]


COLUMNS = ["value", "before", "after", "known", "held"]


def _items(rows: Iterable[tuple], others: list[tuple[str, str]]) -> Items:
    """Findings of a shard (``COLUMNS``) in a fixed order, secrets also in the context of ordinary ones; labels, and which are held out.

    A shard without ordinary findings takes the contexts (before, after) of ``others``.
    """
    rows = sorted(rows)
    yes, no = ([(before, value, after, held) for value, before, after, known, held in rows if known == kind] for kind in (1, 0))
    # The same secrets in the context of other findings, so that the value alone can tell.
    around = [(before, after) for before, _, after, _ in no] or others
    moved = [(around[i % len(around)][0], value, around[i % len(around)][1], held) for i, (_, value, _, held) in enumerate(yes)] if around else []
    every = yes + moved + no
    label = np.array([1] * (len(yes) + len(moved)) + [0] * len(no))
    return [item[:3] for item in every], label, np.array([item[3] == 1 for item in every])


def other_contexts(found: DataFrame) -> list[tuple[str, str]]:
    """Contexts of ordinary findings for shards that have none: of the first ``SHARD`` by hash, which are short and come to the driver."""
    order = [F.xxhash64("value", "before", "after", F.lit(SEED)), "value", "before", "after"]
    return [tuple(row) for row in found.filter("known = 0").orderBy(*order).select("before", "after").limit(SHARD).collect()]


def packed(found: DataFrame, shards: int) -> DataFrame:
    """One row per shard with all its findings, written once for all epochs."""
    rows = found.repartition(shards, "shard").groupBy("shard").agg(F.collect_list(F.struct(*COLUMNS)).alias("rows"))
    return settle(rows, "shards")


def trained(shards: DataFrame, others: list[tuple[str, str]], network: Network, weights: np.ndarray, epochs: int, seed: int) -> Network:
    """The mean of the networks that the shards train from ``network``. One row per parameter comes to the driver."""
    shapes = [part.shape for part in network.parts]

    def step(rows: list[dict]) -> list[tuple]:
        items, label, held = _items([tuple(row.values()) for row in rows], others)
        if held.all():  # nothing is learned here, so nothing is averaged
            return []
        own = copy.deepcopy(network)
        own.train([window_ids(*item) for item, out in zip(items, held) if not out], label[~held], weights[label[~held]], epochs, seed)
        flat = np.concatenate([part.ravel() for part in own.parts]).astype(np.float64)
        return [(np.rint(flat * FIXED).astype(np.int64).tolist(),)]

    rows = by_row(shards, ["rows"], lambda: step, "flat array<long>").select(F.posexplode("flat").alias("place", "part"))
    sums = rows.groupBy("place").agg(F.sum("part").alias("total"), F.count("*").alias("shards")).toPandas().sort_values("place")
    flat = sums["total"].to_numpy() / sums["shards"].to_numpy() / FIXED
    out, cuts = copy.deepcopy(network), np.cumsum([np.prod(shape, dtype=int) for shape in shapes])[:-1]
    out.parts = [part.reshape(shape).astype(np.float32) for part, shape in zip(np.split(flat, cuts), shapes)]
    return out


def held_scores(found: DataFrame, others: list[tuple[str, str]], network: Network, weights: np.ndarray) -> DataFrame:
    """All held-out findings: highest score of the windows, label and weight."""

    def step(group: pa.Table) -> list[tuple]:
        items, label, held = _items(zip(*[group.column(name).to_pylist() for name in COLUMNS]), others)
        places = np.nonzero(held)[0].tolist()
        if not places:
            return []
        windows = [window_ids(*items[place]) for place in places]
        score = network.score(np.concatenate(windows)).astype(np.float64)
        best = np.maximum.reduceat(score, np.cumsum([0, *map(len, windows)])[:-1])
        return list(zip(best.tolist(), label[places].tolist(), weights[label[places]].tolist()))

    return by_group(found, ["shard"], COLUMNS, step, "score double, label long, weight double")


def fit(df: DataFrame, key: str = "doc_id", text: str = "text") -> Detector | None:
    """The detector, or None where the documents do not have findings of both kinds, held out and not."""
    held = (F.pmod(F.xxhash64("value", F.lit(SEED)), F.lit(FOLDS)) == 0).cast("long")
    found = settle(labelled_findings(df, key, text).withColumn("held", held), "findings")
    length = F.length("before") + F.length("value") + F.length("after")
    windows = F.greatest(F.ceil((length - WINDOW) / (WINDOW // 2)), F.lit(0)) + 1
    sums = found.groupBy("known", "held").agg(F.count("*").alias("findings"), F.sum(windows).alias("windows")).collect()
    sizes = {(row.known, row.held): row.findings for row in sums}
    if len(sizes) < 4:
        return None
    no, yes = (sizes[known, 0] + sizes[known, 1] for known in (0, 1))
    weights = np.array([min(1.0, yes / no), min(1.0, no / yes)])
    shards = max(-(-(yes + no) // SHARD), -(-sum(row.windows for row in sums) // WINDOWS))
    found = found.withColumn("shard", F.pmod(F.xxhash64("value", "before", "after", F.lit(SEED + 1)), F.lit(shards)))
    dealt, others = packed(found, shards), other_contexts(found) if shards > 1 else []
    network = Network()
    if shards == 1:
        network = trained(dealt, others, network, weights, EPOCHS, SEED)
    else:
        for epoch in range(EPOCHS):
            network = trained(dealt, others, network, weights, 1, SEED + epoch)
    scores = settle(held_scores(found, others, network, weights), "scores")
    slope, offset = logistic_fit(scores)
    secrets = scores.filter("label = 1").select("score")
    size = secrets.count()
    rank = int((size - 1) * (1 - RECALL))
    best = values_at(secrets, {"score": [rank if slope >= 0 else size - 1 - rank]})
    detector = Detector(network, slope, offset, 0.0)
    detector.threshold = max(LOWEST, float(detector.chance(np.array(list(best.values())))[0]))
    return detector


FINDING = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("probability", pa.float64())])
SCHEMA = "doc_id long, findings array<struct<kind: string, first: long, stop: long, probability: double>>"


def scan(df: DataFrame, detector: Detector | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All findings of every row in order; base findings have no probability."""

    def findings(value: str) -> list[dict]:
        base = base_findings(value)
        rows = [(start, kind, end, None) for start, kind, end in base]
        spans = [(start, end) for start, end, known in candidates(value, base) if not known] if detector else []
        for first in range(0, len(spans), PIECE):
            some = spans[first : first + PIECE]
            chance = detector.probability([_context(value, *span) for span in some])
            rows += [(start, len(KINDS) - 1, end, float(p)) for (start, end), p in zip(some, chance) if p >= detector.threshold]
        return [{"kind": KINDS[kind], "first": start, "stop": end, "probability": p} for start, kind, end, p in sorted(rows, key=lambda r: r[:3])]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, found = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.list_(FINDING))], names=["doc_id", "findings"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for part in batches:
            for number, value in zip(values(part.column(0)), values(part.column(1))):
                out.append((number, findings(value or "")))
                if len(out) >= SEND:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base findings of every row, their digest, and all spans as text."""

    def spans(rows: F.Column) -> F.Column:
        return F.concat_ws(",", F.transform(rows, lambda f: F.concat_ws(":", f.kind, f.first.cast("string"), f.stop.cast("string"))))

    def of(kind: str) -> F.Column:
        return F.filter("findings", lambda f: f.kind == kind)

    base = F.filter("findings", lambda f: f.kind != KINDS[-1])
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans"), counts[3])
