"""Mixing sources to target weights by entropy balancing.

Every token of a document gets the same rate. Among all rates that give each source its target
number of tokens, those nearest to 1 in relative entropy are wanted. They have the form
``exp(tilt)`` with one dual variable per source, and the dual::

    sum over documents of size * exp(tilt[source]) - sum over sources of tilt * target

is convex. Each Newton step needs the tilted tokens of every source (gradient and Hessian at
once: sources do not share tokens, so the Hessian is diagonal). The documents are summed per
source once, combined before the shuffle; the steps run on the table of sources as a DataFrame.
Since all documents of a source have one rate, no target above twice the size of its source
lets a document exceed two copies.

**Targets.** A source's share is its weight; weights 3, 1, 2 repeat over the sources in code
point order, null last. A source stops at ``limit`` times its size and the excess is shared
by weight among the others until none is above: rounds of two sums over the sources.

**Rounding.** Rates become whole copies: ``floor(rate)`` or one more. Documents of a source are
dealt by hash into groups of about ``GROUP`` documents (their number is counted, so a source with a
third of all rows is many groups; of rows with the same id and text every ``EQUAL`` go to the next group). A group goes through its documents from the longest to the
shortest and gives the extra copy whenever the tokens taken so far would else fall behind by
more than half of the document. What a group misses at the end is about half of a short document.

Defined cases: a null text has size 0 and takes nothing; null sources are one source and come
last; repeated rows are documents of their own; with no words at all the targets are 0; an empty
table gives an empty table. Order within a group is by size, id and a hash, so reruns agree. Other
columns are ignored by :func:`mix` and kept by :func:`mixed_rows`.
"""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlode.llm.common import free_names, word_count
from shiftlode.session import settle

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
GROUP = 1000
EQUAL = 100  # rows with the same id and text that go to one group
TOLERANCE = 1e-12
STEPS = 200  # Newton needs about log(size / target) steps


def _ranked(sources: DataFrame) -> DataFrame:
    """Number sources in code point order, null last. Binary order is code point order.

    One row per source comes together here; a source is a counted name, not a document.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    return sources.withColumn("_rank", F.row_number().over(order) - 1)


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``source_size``."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank") % len(weights) + 1)
    ranked = settle(_ranked(sources).withColumn("_weight", weight.cast("double")), "sources")
    top = F.col("source_size") * F.lit(float(limit))
    stopped = F.lit(False)
    while True:
        total, held, free, number = ranked.agg(
            F.sum("source_size"),
            F.sum(F.when(stopped, top).otherwise(0.0)),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("_weight"))),
            F.count(F.when(stopped, 1)),
        ).first()
        if not total or not free:
            break
        rate = (share * total - held) / free
        reached = stopped | (F.col("_weight") * F.lit(rate) > top)
        if ranked.filter(reached).count() == number:
            return ranked.select(
                "source", "source_size", F.when(stopped, top).otherwise(F.col("_weight") * F.lit(rate)).alias("target")
            )
        stopped = reached
    return ranked.select("source", "source_size", F.when(F.lit(bool(total)), top).otherwise(0.0).alias("target"))


def tilts(targets: DataFrame) -> DataFrame:
    """Newton steps on the dual: adds ``rate``, the exponential tilt of each source.

    The state is one number per source. Sources without words or without a target have rate 0.
    """
    solvable = (F.col("source_size") > 0) & (F.col("target") > 0)
    state = targets.withColumn("_tilt", F.when(solvable, F.lit(0.0)))
    for step in range(1, STEPS + 1):
        tilted = F.col("source_size") * F.exp("_tilt")
        state = state.withColumn("_tilt", F.col("_tilt") - (tilted - F.col("target")) / tilted)
        if step % 5 == 0:  # the plan stays short, a lost executor costs little
            state = settle(state, "tilts")
            gap = F.abs(F.col("source_size") * F.exp("_tilt") - F.col("target")) / F.col("target")
            worst = state.agg(F.max(gap)).first()[0]
            if worst is None or worst < TOLERANCE:
                break
    return state.select("source", "source_size", "target", F.coalesce(F.exp("_tilt"), F.lit(0.0)).alias("rate"))


def _copies(group: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of the documents of one group, longest first."""
    group = group.sort_values(["size", "doc_id", "tie"], ascending=[False, True, True], na_position="first")
    wanted, taken, out = 0.0, 0, []
    for size, rate in zip(group["size"].tolist(), group["rate"].tolist()):
        rate = round(rate, 9)  # a rate of two is two copies
        wanted += size * rate
        copies = int(rate) if size else 0
        if copies < rate and wanted - (taken + copies * size) > size / 2:
            copies += 1
        taken += copies * size
        out.append(copies)
    return group.assign(copies=out)[["doc_id", "tie", "size", "source_size", "target", "copies"]]


def _dealt(docs: DataFrame) -> DataFrame:
    """``docs`` with ``deal``, which numbers every ``EQUAL`` rows with the same id and text; which of them get a number is all the same."""
    same = docs.groupBy("doc_id", "source", "size", "tie").agg(F.count("*").alias("_rows"))
    last = F.floor((F.col("_rows") - 1) / F.lit(EQUAL))
    runs = same.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.col("_rows") - F.col("deal") * EQUAL, F.lit(EQUAL)).cast("int")
    return runs.withColumn("_one", F.explode(F.sequence(F.lit(1), size))).drop("_rows", "_one")


def _rounded(docs: DataFrame, rates: DataFrame, counts: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, size, tie) with the copies of every row."""
    known = rates.join(counts, rates["source"].eqNullSafe(counts["source"])).select(
        rates["source"].alias("_source"), "source_size", "target", "rate",
        F.ceil(F.col("documents") / F.lit(GROUP)).alias("_groups"),
    )
    joined = _dealt(docs).join(known, F.col("source").eqNullSafe(F.col("_source")))
    own = F.pmod(F.xxhash64("doc_id", "tie"), F.col("_groups"))
    group = F.pmod(own + F.col("deal"), F.col("_groups")).alias("_group")
    return (
        joined.select("doc_id", "tie", "size", "source_size", "target", "rate", "_source", group)
        .groupBy("_source", "_group")
        .applyInPandas(
            _copies, "doc_id long, tie long, size long, source_size long, target double, copies long"
        )
    )


def copies(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
) -> DataFrame:
    """doc_id, tie (hash of the text), size, source_size, target and copies of every row."""
    docs = settle(
        df.select(
            F.col(key).cast("long").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(text).cast("long").alias("size"),
            F.xxhash64(F.col(text)).alias("tie"),
        ),
        "sizes",
    )
    sums = settle(docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents")), "sums")
    rates = tilts(source_targets(sums.select("source", "source_size"), weights, share, limit))
    return _rounded(docs, rates, sums.select("source", "documents"))


def mix(df: DataFrame, **options) -> DataFrame:
    """Per document the words that the mix takes, repeats counted."""
    return copies(df, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mixed_rows(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it. Rows without words are left out.

    Rows with the same id and text are exchangeable: their copies are added up and dealt out as one
    list to the first of them.
    """
    own, tie, times, number, place, time = free_names(df, "_doc", "_tie", "_times", "_rows", "_place", "_time")
    many = copies(df, key, text, source, **options).groupBy("doc_id", "tie").agg(F.sum("copies"), F.count("*"))
    many = many.toDF(own, tie, times, number).filter(F.col(times) > 0)
    joined = df.join(many, df[key].cast("long").eqNullSafe(many[own]) & (F.xxhash64(df[text]) == many[tie]))
    columns = [F.col(f"`{name}`") for name in df.columns]
    single = joined.filter(F.col(number) == 1)
    rest = [F.col(f"`{name}`") for name in sorted(df.columns, key=lambda name: name == text)]
    repeated = joined.filter(F.col(number) > 1).groupBy(own, tie).agg(F.min(F.struct(*rest)).alias(place), F.first(times).alias(times))
    repeated = repeated.select(*[F.col(f"`{place}`.`{name}`") for name in df.columns], times)
    single = single.select(*columns, times)
    rows = single.unionByName(repeated)
    return rows.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*columns)
