"""Language identification by Bayesian evidence fusion.

For every row four kinds of evidence are multiplied:

* **text**: naive Bayes over hashed letter trigrams of the whole text. Overlapping trigrams are not
  independent, so the mean log-likelihood counts as ``n * PULL / (n + PULL)`` observations. Beside the
  languages there is ``und``, under which all trigrams are equally likely; texts that fit
  no language go there.
* **declared** markup language: ``P(declared | language)``, counted over all rows.
* **address suffix** and **host**: a prior that is smoothed hierarchically. The shares of languages of
  all rows smooth those of a suffix, and these smooth those of a host, each with the weight of
  ``SMOOTH`` rows.

Counts are sums of text posteriors, grouped over (host, suffix, declared) with combining before the
shuffle, so a hot host is one row per task. The declared table has (languages + 2) x languages cells.
Of a page, the text is what its own marks call content, with references decoded (:mod:`shiftlode.llm.template`
without the counts of the host).
Only the table of hosts meets the rows again, by a join on the host that carries no texts.

The trigram model is fitted on about ``FIT_ROWS`` rows with a declared language (a documented bound,
picked by a hash of the text); everything else covers all rows.

A row is kept if its language is not ``und`` and its posterior is at least ``MIN_POSTERIOR``.

Defined cases: a null or empty text, or one without letters, has no text evidence, is ``und`` with
posterior 1 and is not kept; very long texts are read whole, slice by slice; of languages with equal posteriors the first in
code order counts (``und`` last); null hosts and suffixes are groups of their own; an unknown declared
language is ``other``, a missing one ``none``; repeated rows get equal results; an empty table gives an
empty table; further columns are ignored by :func:`identify` and kept by :func:`kept_rows`.
"""

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import arrow_types, by_row, to_batch, values
from shiftlode.llm.template import host_of, read_page
from shiftlode.session import settle

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
CODES = 1 << 15
FIT_ROWS = 4000
PULL = 60.0
SMOOTH = 50.0
EVEN = 0.05  # share of a language's trigrams that can be any
SURPRISE = 1e-3  # prior share of ``und``
MIN_POSTERIOR = 0.5
SLICE = 1 << 20

# ASCII: letters in lower case stay, all else is a blank. Other bytes stay.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigram_codes(text: str | None) -> Iterator[np.ndarray]:
    """Hashed trigrams of the letters of a text, slice by slice."""
    for start in range(0, len(text or ""), SLICE):
        part = text[start : start + SLICE].lower().encode("utf-8", "surrogatepass").translate(LETTERS)
        data = np.frombuffer(b" " + b" ".join(part.split()) + b" ", np.uint8).astype(np.uint32)
        if len(data) > 2:
            mixed = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
            yield (mixed ^ (mixed >> 15)) % CODES


class TextModel:
    """Log-probabilities of trigrams: one column per language and one for ``und``."""

    def __init__(self, counts: np.ndarray, languages: Sequence[str]):
        """``counts``: codes x languages."""
        self.languages = [*languages, UNKNOWN]
        even = np.full((CODES, 1), 1.0 / CODES)
        share = counts / np.maximum(counts.sum(axis=0), 1)
        self.logs = np.log(np.hstack([(1 - EVEN) * share + EVEN / CODES, even])).astype(np.float32)

    def evidence(self, text: str | None) -> tuple[int, list[float]]:
        """Number of trigrams and the damped log-likelihood of every language."""
        total, size = np.zeros(len(self.languages)), 0
        for codes in trigram_codes(text):
            total += np.bincount(codes, minlength=CODES).astype(np.float32) @ self.logs if len(codes) > CODES else self.logs[codes].sum(axis=0, dtype=np.float64)
            size += len(codes)
        return size, (total * (PULL / (size + PULL))).tolist()


def fit(df: DataFrame, text: str, declared: str, languages: Sequence[str] = LANGUAGES) -> TextModel:
    """Trigram counts of about ``FIT_ROWS`` rows; at most codes x languages sums reach the driver."""
    names = list(languages)
    label = _declared(F.col(declared), names)
    usable = df.select(F.col(text).alias("_text"), label.alias("_label")).filter(F.col("_label").isin(names) & F.col("_text").isNotNull())
    share = min(1.0, FIT_ROWS / max(usable.select("_label").count(), 1))
    chosen = usable.filter(F.pmod(F.xxhash64("_text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    schema = "_label string, _code long, _count long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), CODES), np.int64)
        for batch in batches:
            for value, name in zip(values(batch.column(0)), values(batch.column(1))):
                for codes in trigram_codes(value):
                    sums[names.index(name)] += np.bincount(codes, minlength=CODES)
        rows = [(names[i], j, int(sums[i, j])) for i, j in zip(*[x.tolist() for x in np.nonzero(sums)])]
        yield to_batch(rows, ["_label", "_code", "_count"], arrow_types(schema))

    counts = np.zeros((CODES, len(names)))
    grouped = chosen.mapInArrow(run, schema).groupBy("_label", "_code").agg(F.sum("_count").alias("n")).toPandas()
    counts[grouped["_code"].to_numpy(int), [names.index(x) for x in grouped["_label"]]] = grouped["n"]
    return TextModel(counts, names)


def _declared(column, languages: Sequence[str]):
    """First part of a language tag in lower case, ``other`` or ``none``."""
    tag = F.lower(F.trim(F.regexp_replace(column.cast("string"), "[-_].*$", "")))
    return F.when(F.coalesce(tag, F.lit("")) == "", "none").when(tag.isin(*languages), tag).otherwise("other")


def _softmax(logs):
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda x: x / total)


def _fused(
    df: DataFrame, model: TextModel, key: str, text: str, declared: str | None, host: str | None, suffix: str | None
) -> DataFrame:
    """key, _host, _suffix, _declared, _tie and the posterior of every row."""
    names = model.languages
    number = len(names)

    def step():
        return lambda one, two, three, four, five, value: [(one, two, three, four, five, *model.evidence(value))]

    field = lambda name: F.col(name).cast("string") if name else F.lit(None).cast("string")
    rows = df.select(
        F.col(key).cast("long").alias("_key"),
        field(host).alias("_host"),
        field(suffix).alias("_suffix"),
        _declared(field(declared), names[:-1]).alias("_declared"),
        F.xxhash64(F.col(text)).alias("_tie"),
        F.col(text).alias("_text"),
    )
    schema = "_key long, _host string, _suffix string, _declared string, _tie long, _size long, _logs array<double>"
    scored = settle(by_row(rows, ["_key", "_host", "_suffix", "_declared", "_tie", "_text"], step, schema), "evidence")

    # One row per host, suffix and declared language; rows without letters count for nothing.
    before = F.array(*[F.lit(float(np.log((1 - SURPRISE) / (number - 1))))] * (number - 1), F.lit(float(np.log(SURPRISE))))
    posterior = F.when(F.col("_size") > 0, _softmax(F.zip_with(F.col("_logs"), before, lambda a, b: a + b)))
    shares = [F.coalesce(F.sum(F.col("_posterior")[i]), F.lit(0.0)).alias(f"c{i}") for i in range(number)]
    cells = settle(scored.withColumn("_posterior", posterior).groupBy("_host", "_suffix", "_declared").agg(*shares), "language-cells")
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(number)]

    told: dict[str, list[float]] = {row["_declared"]: list(row)[1:] for row in cells.groupBy("_declared").agg(*sums).collect()}
    everything = [sum(row[i] for row in told.values()) for i in range(number)]
    total = sum(everything)
    general = [(x + 1.0) / (total + number) for x in everything]
    general = [x * (1 - SURPRISE) for x in general[:-1]] + [SURPRISE]
    # P(declared | language); for und it is the share of all rows, so that it says nothing.
    kinds = [*names[:-1], "other", "none"]
    logs = {
        kind: [float(np.log((told.get(kind, [0.0] * number)[i] + 1.0) / (everything[i] + len(kinds)))) for i in range(number - 1)]
        for kind in kinds
    }
    for kind in kinds:
        logs[kind].append(float(np.log((sum(told.get(kind, [0.0])) + 1.0) / (total + len(kinds)))))
    said = F.element_at(
        F.create_map(*[x for kind in kinds for x in (F.lit(kind), F.array(*map(F.lit, logs[kind])))]), F.col("_declared")
    )

    def smoothed(counts: str, base):
        whole = sum((F.col(f"{counts}{i}") for i in range(number)), F.lit(0.0)) + F.lit(SMOOTH)
        return [(F.col(f"{counts}{i}") + F.lit(SMOOTH) * base[i]) / whole for i in range(number)]

    suffixes = cells.groupBy("_suffix").agg(*sums)
    suffixes = suffixes.select("_suffix", *[x.alias(f"s{i}") for i, x in enumerate(smoothed("c", [F.lit(x) for x in general]))])
    hosts = cells.groupBy("_host", "_suffix").agg(*sums).alias("h")
    joined = hosts.join(suffixes.alias("s"), F.col("h._suffix").eqNullSafe(F.col("s._suffix")))
    prior = F.array(*smoothed("c", [F.col(f"s{i}") for i in range(number)]))
    priors = settle(joined.select(F.col("h._host").alias("_h"), F.col("h._suffix").alias("_s"), prior.alias("_prior")), "language-priors")

    met = scored.join(priors, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_suffix").eqNullSafe(F.col("_s")))
    mixed = F.zip_with(F.zip_with(F.col("_logs"), said, lambda a, b: a + b), F.col("_prior"), lambda a, b: a + F.log(b))
    met = met.withColumn("_posterior", _softmax(mixed))
    best = F.when(F.col("_size") > 0, F.array_max("_posterior")).otherwise(1.0)
    place = F.array_position("_posterior", F.array_max("_posterior")).cast("int")
    language = F.when(F.col("_size") > 0, F.element_at(F.array(*map(F.lit, names)), place)).otherwise(UNKNOWN)
    return met.select(
        "_key", "_host", "_suffix", "_declared", "_tie", language.alias("language"), best.alias("posterior"), F.col("_size").alias("n_trigrams")
    ).withColumn("kept", (F.col("language") != UNKNOWN) & (F.col("posterior") >= MIN_POSTERIOR))


def identify(
    df: DataFrame, key: str = "doc_id", text: str = "text", declared: str | None = "lang",
    host: str | None = "source", suffix: str | None = None, languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """Language, posterior and verdict of every row. Runs the fit and the counts at once."""
    fused = _fused(df, fit(df, text, declared, languages), key, text, declared, host, suffix)
    return fused.select(F.col("_key").alias(key), F.col("language"), "posterior", F.col("_declared").alias("declared"), "n_trigrams", "kept")


def kept_rows(
    df: DataFrame, key: str = "doc_id", text: str = "text", declared: str | None = "lang",
    host: str | None = "source", languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns.

    What is rejected is written first, so that Spark knows its size when it picks the anti join.
    """
    fused = _fused(df, fit(df, text, declared, languages), key, text, declared, host, None)
    out = settle(fused.filter(~F.col("kept")).select("_key", "_host", "_declared", "_tie").distinct(), "rejected")
    same = (
        df[key].cast("long").eqNullSafe(out["_key"])
        & (F.xxhash64(df[text]) == out["_tie"])
        & df[host].cast("string").eqNullSafe(out["_host"])
        & (_declared(df[declared], languages) == out["_declared"])
    )
    return df.join(out, same, "left_anti")


def page_evidence(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, text, declared language, host and address suffix of web pages, for :func:`identify`. Pages are read and written at once."""
    host = host_of(F.col(url))
    named = F.regexp_extract(F.col(html), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1)
    rows = pages.select(
        F.col(key).cast("long").alias("_key"),
        F.col(html).alias("_html"),
        F.when(named != "", named).alias("_named"),
        host.alias("_host"),
        F.when(host.contains("."), F.substring_index(host, ".", -1)).alias("_suffix"),
    )

    def step():
        return lambda number, source, *rest: [(number, main_text(source), *rest)]

    schema = "_key long, text string, declared string, host string, suffix string"
    read = by_row(rows, ["_key", "_html", "_named", "_host", "_suffix"], step, schema)
    return settle(read, "page-texts").withColumnRenamed("_key", key)


def main_text(source: str | None) -> str:
    """Blocks of a page that its own marks call content."""
    texts, content = read_page(source)[:2]
    return "\n".join(text for text, inside in zip(texts, content) if inside)
