"""Dumps whose texts and comments hold the ends of statements, read in splits of any size."""

import random

import pyarrow as pa
import pytest

from shiftlode import schemas
from shiftlode.sources import dump

HEAD = "INSERT INTO mines (mine_id, mine_code, mine_name, location, operational_status) VALUES "
PARTS = [";\n", "''", "--", "/*", "*/", "a", " ", ";", "\n", "INSERT INTO mines VALUES (1);\n", "(b)", ",", "ü"]


def states_of(text):
    """State by state, character by character."""
    ends = []
    for state in range(3):
        i, line = 0, False
        while i < len(text):
            two = text[i : i + 2]
            if line:
                line = text[i] != "\n"
            elif state == dump.IN_QUOTE:
                if two == "''":
                    i += 1
                elif text[i] == "'":
                    state = dump.OUTSIDE
            elif state == dump.IN_COMMENT:
                if two == "*/":
                    state, i = dump.OUTSIDE, i + 1
            elif two == "--":
                line = True
            elif two == "/*":
                state, i = dump.IN_COMMENT, i + 1
            elif text[i] == "'":
                state = dump.IN_QUOTE
            i += 1
        ends.append(state)
    return ends


def test_end_states(spark):
    source = random.Random(4)
    texts = ["".join(source.choice(["'", "''", "--", "/*", "*/", "-", "/", "*", "a", "\n", ";"]) for _ in range(source.randrange(14))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    from pyspark.sql import functions as F

    for row in rows.select("value", dump._end_states(F.col("value")).alias("ends")).collect():
        assert row["ends"] == states_of(row["value"]), row["value"]


def written(source, n):
    """A dump of ``n`` mines, the texts made of parts that look like ends, quotes and comments, and the rows in it."""
    out, rows = [], []
    for number in range(n):
        text = "".join(source.choice(PARTS) for _ in range(source.randrange(12)))
        comment = source.choice(["", "", "/* it's;\n */ ", "-- don't;\n", "/* -- ;\n ' */\n"])
        out.append(f"{comment}{HEAD}({number}, 'c', 'n', '{text}', 'x');\n")
        rows.append((number, text.replace("''", "'")))
    return "".join(out), rows


@pytest.mark.parametrize("split", [37, 1000, 1 << 27])
def test_cut_texts_in_splits(spark, tmp_path, split):
    source = random.Random(split)
    want = []
    for number in range(2):
        text, rows = written(source, 80)
        (tmp_path / f"part-{number}.sql").write_text(text)
        want += rows
    old = [(name, spark.conf.get(name)) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        records = dump.mine_records(spark, str(tmp_path))
        found = sorted((row.mine_id, row.location or "") for row in dump.accepted(records).collect())
        assert dump.rejects(records, "mines").count() == 0
    finally:
        for name, value in old:
            spark.conf.set(name, value)
    # Blanks around values and the empty text are read as before.
    assert [(n, t.strip(" ")) for n, t in found] == [(n, t.strip(" ")) for n, t in sorted(want)]


def test_text_that_is_never_closed_stays_in_its_pieces(spark, tmp_path):
    good = f"{HEAD}(1, 'c', 'n', 'a;\nb', 'x');\n"
    (tmp_path / "a.sql").write_text(good + f"{HEAD}(2, 'c', 'n', 'open, 'x);\n" + f"{HEAD}(3, 'c', 'n', 'l', 'x');\n")
    (tmp_path / "b.sql").write_text(good.replace("(1,", "(4,") + "/* to the end;\n" + f"{HEAD}(5, 'c', 'n', 'l', 'x');\n")
    pieces = dump.read_statements(spark, str(tmp_path))
    records = dump.parse_records(pieces, "mines", schemas.MINES)
    assert {row.mine_id for row in dump.accepted(records).collect()} >= {1, 4}


def test_dump_without_cut_texts_is_not_joined(spark, tmp_path):
    (tmp_path / "a.sql").write_text(f"{HEAD}(1, 'c', 'it''s', '-- a', 'x');\n/* b */ {HEAD}(2, 'c', 'n', 'l', 'x');\n")
    pieces = dump.read_statements(spark, str(tmp_path))
    assert "Join" not in pieces._jdf.queryExecution().optimizedPlan().toString() and pieces.count() == 2
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.sql").write_text("")
    assert dump.read_statements(spark, str(tmp_path / "empty")).count() == 0


def test_listed_pieces_come_one_by_one(spark):
    """A block of many listed pieces reaches Python in rows of two numbers a piece, never whole."""
    code = dump.ENDS.index((0, 0, 2))
    odd = "array<struct<place: long, code: tinyint>>"
    rows = [("f", 0, 0, 30_000, [(i, code) for i in range(30_000)]), ("f", 9, 30_001, 30_004, [])]
    blocks = spark.createDataFrame(rows, f"file string, block long, first long, last long, odd {odd}")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    pieces = dump._exploded(blocks)
    assert pieces.columns == ["file", "block", "place", "code"]
    found = [row.n for row in pieces.coalesce(1).mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 30_001 and max(found) <= 10_000
    assert dump._block_starts(blocks) == ([], [])
