"""Helpers shared by the operators: reading tables, row-wise Arrow steps, words."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def values(column: pa.Array) -> Iterator:
    """The values of a column one by one, so that long texts are not all copied at once."""
    for value in column:
        yield value.as_py()


def by_row(df: DataFrame, columns: list[str], step: Callable[[], Callable], schema: str) -> DataFrame:
    """Run a Python step on every row, Arrow batch by Arrow batch.

    ``step()`` is called once per task and gives a function from the values of ``columns``
    to an iterable of result tuples. Results are sent on after ``SEND`` rows.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    types = arrow_types(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = step()
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*[values(batch.column(i)) for i in range(len(columns))]):
                out.extend(each(*row))
                if len(out) >= SEND:
                    yield to_batch(out, names, types)
                    out = []
        if out:
            yield to_batch(out, names, types)

    return df.select(*[F.col(f"`{name}`") for name in columns]).mapInArrow(run, schema)


SEND = 512

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
    "array<array<long>>": pa.list_(pa.list_(pa.int64())),
}


def arrow_types(schema: str) -> list[pa.DataType]:
    return [_ARROW[field.split()[1]] for field in schema.split(", ")]


def to_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, types)], names=names)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but the six ASCII white space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


class WordHashes:
    """64-bit hashes of words. None is kept: to look a word up among many costs more than its hash, and a task's memory too."""

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def hashes_of(words: list[bytes], known: WordHashes) -> np.ndarray:
    return known(words)


def word_count(text: str) -> F.Column:
    """Number of words of a column, in the JVM."""
    spread = F.trim(F.regexp_replace(F.col(text), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(F.coalesce(spread, F.lit("")) == "", F.lit(0)).otherwise(
        F.length(spread) - F.length(F.replace(spread, F.lit(" "))) + 1
    )


def by_group(df: DataFrame, keys: list[str], columns: list[str], step: Callable[[pa.Table], list[tuple]], schema: str) -> DataFrame:
    """Run a Python step on every group of rows with equal ``keys`` (whole numbers).

    For many small groups of bounded size: rows are sorted by key within a task and cut there,
    without one call from Spark per group. ``step`` gets ``columns`` of one group at a time.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    types = arrow_types(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        out: list[tuple] = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            marks = np.stack([rows.column(i).to_numpy() for i in range(len(keys))])
            cuts = np.nonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0))[0] + 1
            for first, stop in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
                out.extend(step(rows.slice(first, stop - first).select(columns)))
                if len(out) >= SEND:
                    yield to_batch(out, names, types)
                    out = []
            held = rows.slice(int(cuts[-1]) if len(cuts) else 0)
        if held is not None and held.num_rows:
            out.extend(step(held.select(columns)))
        if out:
            yield to_batch(out, names, types)

    picked = df.select(*keys, *[name for name in columns if name not in keys]).repartition(*keys).sortWithinPartitions(*keys)
    return picked.mapInArrow(run, schema)
