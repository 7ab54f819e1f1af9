"""Records from a dump of INSERT statements.

The text is read in pieces that end with a semicolon and a line end, so large dumps are
read by many tasks. A piece may hold comments and several statements. It is cut at the
semicolons outside of quotes; a statement may run over lines and insert several rows. What is
an INSERT into the wanted table but cannot be read in full is kept as a reject with its text.

A quoted text or a comment may itself hold a semicolon at a line end, so a piece may start inside of one. Every piece has an
**end state for each start state** (outside, in a quote, in a comment). For nearly all pieces each state ends as it started; only the
others are listed, per block of the file, and read one by one, so Python holds a few pieces at a time. The states of the blocks are composed in order, which fixes the state every
block starts in, and with it the pieces that belong together: those alone are joined by place and put
together again. Text that is still open at the end of a file is left in its pieces.
"""

import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlode import schemas
from shiftlode.functions.scalars import as_double
from shiftlode.session import settle

STATEMENT_END = ";\n"
SEND = 512
OUTSIDE, IN_QUOTE, IN_COMMENT = range(3)

# Grammar of the statements: a quoted text doubles its quotes, a name may be quoted.
QUOTED = "'(?:[^']++|'')*+'"
COMMENT = r"--[^\n]*+|/\*(?s:.*?)\*/"
STATEMENT = rf"((?:[^';]++|{QUOTED}|'(?:[^']++|'')*+$)++)"
ROW = rf"\(((?:[^'()]++|{QUOTED})*+)\)"

# Options under which the values of a row read as one CSV record.
VALUE_OPTIONS = {
    "quote": "'",
    "escape": "'",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "NULL",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_reject",
}


def read_statements(spark: SparkSession, path: str, end: str = STATEMENT_END) -> DataFrame:
    """The text in pieces that end with ``end`` (``";\\r\\n"`` for other line ends) outside of quoted texts and comments."""
    return whole_pieces(spark.read.option("lineSep", end).text(path), end)


def _end_states(text: Column) -> Column:
    """End state of a piece for each start state. A comment to the end of a line ends with the piece at the latest."""

    def from_outside(rest: Column) -> Column:
        # What is left when everything complete has been taken from the front starts with what is still open.
        left = F.regexp_replace(rest, rf"^(?:[^'/-]++|{QUOTED}|--[^\n]*+|/\*(?s:.*?)\*/|-(?!-)|/(?!\*))*+", "")
        return F.when(left == "", OUTSIDE).when(left.startswith("'"), IN_QUOTE).otherwise(IN_COMMENT)

    quoted = r"^(?:[^']++|'')*+'"
    from_quote = F.when(F.regexp_extract(text, quoted, 0) == "", IN_QUOTE).otherwise(from_outside(F.regexp_replace(text, quoted, "")))
    commented = F.instr(text, "*/")
    from_comment = F.when(commented == 0, IN_COMMENT).otherwise(from_outside(F.substring(text, commented + 2, F.length(text))))
    return F.array(from_outside(text), from_quote, from_comment)


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with file, block and place; a block is read by one task, in order."""
    return pieces.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def _ends(code: int) -> tuple[int, int, int]:
    """The end states that :func:`whole_pieces` writes as one number."""
    return code % 3, code // 3 % 3, code // 9


ENDS = [_ends(code) for code in range(27)]
UNCHANGED = ENDS.index((OUTSIDE, IN_QUOTE, IN_COMMENT))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _exploded(blocks: DataFrame, *names: str) -> DataFrame:
    """The listed pieces of blocks one by one, in order; a block without any has one row of an unchanged state."""
    piece = F.explode(F.when(F.size("odd") > 0, F.col("odd")).otherwise(F.array(F.struct(F.col("first").alias("place"), F.lit(UNCHANGED).cast("byte").alias("code")))))
    return blocks.select("file", "block", *names, piece.alias("piece")).select("file", "block", *names, "piece.place", "piece.code")


def whole_pieces(pieces: DataFrame, end: str = STATEMENT_END) -> DataFrame:
    """Pieces as read from files, those put together that were cut inside of a quoted text or a comment."""
    spark, placed, value = pieces.sparkSession, _placed(pieces), F.col("value")
    quotes = F.length("value") - F.length(F.replace(value, F.lit("'")))
    # With paired quotes and no signs of comments every state ends as it started.
    listed = (quotes % 2 == 1) | value.contains("--") | value.contains("/*") | value.contains("*/")
    ends = _end_states(value)
    code = F.when(listed, F.aggregate(F.reverse(ends), F.lit(0), lambda all_, end: all_ * 3 + end)).cast("byte")
    placed_codes = placed.select("file", "block", "place", code.alias("code"))
    odd = F.when(F.col("code") != UNCHANGED, F.struct("place", "code"))
    blocks = settle(
        placed_codes.groupBy("file", "block").agg(
            F.min("place").alias("first"), F.max("place").alias("last"), F.array_sort(F.collect_list(odd)).alias("odd")
        ),
        "blocks",
    )
    starts, lost = _block_starts(blocks)
    if not starts and blocks.where(F.exists("odd", lambda piece: piece.code % 3 != OUTSIDE)).isEmpty():
        return pieces
    begun = spark.createDataFrame(starts, "file string, block long, state int, key_block long, key_place long")
    marked = blocks.join(begun, ["file", "block"], "left").where("state IS NOT NULL OR size(odd) > 0")
    schema = "file string, key_block long, key_place long, first long, last long"

    def spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [field.split()[0] for field in schema.split(", ")], [pa.string()] + [pa.int64()] * 4
        out: list[tuple] = []

        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)], names=names)

        for (file, block), part in itertools.groupby(_pieces(batches), key=lambda row: row[:2]):
            # What lies over several pieces: its first one, and whether it began before the block.
            start, state = None, None
            for _, _, first, last, begun_in, key_block, key_place, place, code in part:
                if state is None:
                    state = begun_in or OUTSIDE
                    start, key = (first, (key_block, key_place)) if state != OUTSIDE else (None, None)
                after = ENDS[code][state]
                if state == OUTSIDE and after != OUTSIDE:
                    start, key = place, (block, place)
                elif state != OUTSIDE and after == OUTSIDE:
                    out.append((file, *key, start, place))
                    start = None
                state = after
                if len(out) >= SEND:
                    yield send()
                    out.clear()
            if start is not None:
                out.append((file, *key, start, last))
        if out:
            yield send()

    key = ["file", "key_block", "key_place"]
    never_closed = spark.createDataFrame(lost, "file string, key_block long, key_place long")
    found = _exploded(marked, "first", "last", "state", "key_block", "key_place").mapInArrow(spans, schema).join(never_closed, key, "left_anti")
    members = settle(found.select(*key, F.explode(F.sequence("first", "last")).alias("place")), "members")
    ordered = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = placed.join(members, ["file", "place"]).groupBy(*key).agg(F.array_join(F.transform(ordered, lambda p: p.value), end).alias("value"))
    return placed.join(members, ["file", "place"], "left_anti").select("value").unionByName(joined.select("value"))


def _block_starts(blocks: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """The blocks that start inside of a text or comment, with its first piece as key; and the keys of what no file closes.

    One short row per block of the files comes to the driver, which has listed the blocks to plan the scan.
    """

    def functions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "ends", "opened"]
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for (file, block), part in itertools.groupby(_pieces(batches), key=lambda row: row[:2]):
            states, opened = [OUTSIDE, IN_QUOTE, IN_COMMENT], [None] * 3
            for _, _, place, code in part:
                ends = ENDS[code]
                for i, state in enumerate(states):
                    if state == OUTSIDE:
                        opened[i] = place
                    states[i] = ends[state]
            yield pa.RecordBatch.from_arrays([pa.array([part], kind) for part, kind in zip((file, block, states, opened), kinds)], names=names)

    rows = sorted(_exploded(blocks).mapInArrow(functions, "file string, block long, ends array<int>, opened array<long>").collect(), key=lambda row: row[:2])
    starts, lost = [], []
    for file, part in itertools.groupby(rows, key=lambda row: row.file):
        state, key = OUTSIDE, None
        for row in part:
            if state != OUTSIDE:
                starts.append((file, row.block, state, *key))
            state, piece = row.ends[state], row.opened[state]
            key = None if state == OUTSIDE else key if piece is None else (row.block, piece)
        if key:
            lost.append((file, *key))
    return starts, lost


def insert_statements(pieces: DataFrame, table: str) -> DataFrame:
    """``statement``: the text of every INSERT into ``table``, without comments."""
    bare = F.regexp_replace("value", rf"({QUOTED})|{COMMENT}", "$1")
    parts = F.regexp_extract_all(bare, F.lit(STATEMENT), F.lit(1))
    head = rf'(?is)^\s*INSERT\s+INTO\s+"?{table}"?\s*[( ].*'
    return (
        pieces.where(F.lower("value").contains(table.lower()))
        .select(F.explode(parts).alias("statement"))
        .where(F.col("statement").rlike(head))
    )


def parse_records(pieces: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` of every row of every INSERT into ``table``, and ``_reject``:
    the text of what could not be read, NULL for good rows.

    The columns are those that the statement names, in its order; without names they are
    the columns of the schema. A row with another number of values or with a value
    that does not fit its type is a reject as a whole.
    """
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    whole = rf'(?is)^\s*INSERT\s+INTO\s+"?{table}"?\s*(?:\(([^)\']*)\))?\s*VALUES\s*({ROW}(?:\s*,\s*{ROW})*+)\s*$'
    found = insert_statements(pieces, table).select(
        "statement",
        F.regexp_replace(F.lower(F.regexp_extract("statement", whole, 1)), r'[\s"]', "").alias("_names"),
        F.regexp_extract("statement", whole, 2).alias("_rows"),
    )
    names = F.lit(",".join(field.name for field in schema))
    known = (F.col("_names") == "") | (F.col("_names") == names)
    values = F.when(known & (F.col("_rows") != ""), F.regexp_extract_all("_rows", F.lit(ROW), F.lit(1)))
    rows = found.select("statement", F.explode_outer(values).alias("_values"))
    parsed = rows.select("statement", "_values", F.from_csv("_values", f"{ddl}, _reject string", VALUE_OPTIONS).alias("_row"))
    reject = F.when(F.col("_values").isNull(), F.col("statement")).otherwise(F.col("_row._reject"))
    return parsed.select(*[F.col(f"_row.{field.name}") for field in schema], reject.alias("_reject"))


def accepted(records: DataFrame) -> DataFrame:
    return records.where("_reject IS NULL").drop("_reject")


def rejects(records: DataFrame, table: str) -> DataFrame:
    """table_name and text of what could not be read."""
    return records.where("_reject IS NOT NULL").select(F.lit(table).alias("table_name"), F.col("_reject").alias("record"))


def parse_inserts(pieces: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Typed rows from the statements for ``table`` in the ``value`` column of ``pieces``."""
    return accepted(parse_records(pieces, table, schema))


def insert_lines(df: DataFrame, table: str) -> DataFrame:
    """The inverse: one INSERT statement per row, in the ``value`` column."""

    def literal(field: T.StructField):
        text = F.col(field.name).cast("string")
        if isinstance(field.dataType, (T.StringType, T.DateType, T.TimestampNTZType)):
            text = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    values = F.concat_ws(", ", *[literal(field) for field in df.schema])
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("value"))


def mine_records(spark: SparkSession, path: str, pieces: DataFrame | None = None) -> DataFrame:
    """Mines with ``_reject``; ``pieces`` are those of :func:`read_statements`, if several tables are read from them."""
    return parse_records(pieces or read_statements(spark, path), "mines", schemas.MINES)


def production_records(spark: SparkSession, path: str, pieces: DataFrame | None = None) -> DataFrame:
    """Shift records as doubles, the type all calculations use, with ``_reject``."""
    records = parse_records(pieces or read_statements(spark, path), "production_logs", schemas.PRODUCTION_LOGS)
    return records.withColumns(
        {name: as_double(F.col(name)) for name in ("tons_extracted", "quality_grade")}
    )


def read_mines(spark: SparkSession, path: str) -> DataFrame:
    return accepted(mine_records(spark, path))


def read_production_logs(spark: SparkSession, path: str) -> DataFrame:
    return accepted(production_records(spark, path))
