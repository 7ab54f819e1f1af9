"""Damage of every kind is located, and nothing else is reported."""

import gzip

import pytest
from pyspark.sql import functions as F

from shiftlode.llm.merkle import audit, damaged_leaves, inflated, parse, replica_tree, row_id, shard_records, tree, write_replica, write_replicas
from shiftlode.session import new_path


def pages(n=300):
    rows = [(i, f"http://h{i % 7}/{i}", f"<p>é {i}</p>\r\n\r\nWARC/1.0\r\n" * (1 + i % 9), "x") for i in range(n)]
    return rows + [(1000, None, None, "x"), (1001, "a\r\nb", "", "x"), (1002, "big", "<b>" * 200_000, "x")]


def replicas(spark, a, b, shard_bytes=4000):
    out, schema = [], "page_id long, url string, html string, shard string"
    for rows in (a, b):
        df = spark.createDataFrame(rows, schema)
        # Same shards for both.
        records = shard_records(spark.createDataFrame(a, schema), shard_bytes=shard_bytes) if rows is a else None
        if records is None:
            total = sum(len((r[2] or "").encode()) for r in a)
            records = shard_records(df, shard_bytes=-(-sum(len((r[2] or "").encode()) for r in rows) // -(-total // shard_bytes)) if rows else 1)
        out.append(write_replica(records, new_path(spark, "warc")))
    return out


def statuses(found):
    return {(r["id"], r["status"]) for r in found.select(row_id("record").alias("id"), "status").collect()}


def test_equal_replicas(spark):
    rows = pages()
    a, b = replicas(spark, rows, list(reversed(rows)))
    assert damaged_leaves(replica_tree(spark, a), replica_tree(spark, b)) is None
    assert statuses(audit(spark, a, b)) == {(r[0], "same") for r in rows}


def test_changed_bytes(spark):
    rows = pages()
    schema = "page_id long, url string, html string, shard string"
    records = shard_records(spark.createDataFrame(rows, schema), shard_bytes=4000)
    hit = "_order % 50 = 7"
    copies = {
        "a": F.expr("CASE WHEN _order = 9 THEN replace(record, '<p>', '<q>') ELSE record END"),
        "b": F.expr(f"CASE WHEN {hit} OR _order = 9 THEN replace(record, '</p>', '</r>') ELSE record END"),
    }
    a, b = write_replicas(records, new_path(spark, "warc"), copies)
    expected = {(r[0], "damaged in b" if r[0] % 50 == 7 else "damaged in both" if r[0] == 9 else "same") for r in rows}
    found = audit(spark, a, b)
    assert statuses(found) == expected and found.count() == len(rows)
    leaves = damaged_leaves(replica_tree(spark, a), replica_tree(spark, b))
    assert leaves.count() == sum(r[0] % 50 == 7 or r[0] == 9 for r in rows)


def test_missing_records(spark):
    rows = pages(60)
    schema = "page_id long, url string, html string, shard string"
    records = shard_records(spark.createDataFrame(rows, schema), shard_bytes=3000)
    a = write_replica(records, new_path(spark, "warc"))
    b = write_replica(records.filter("_order <> 20"), new_path(spark, "warc"))
    got = statuses(audit(spark, a, b))
    assert (20, "missing in b") in got and {s for _, s in got} <= {"same", "moved", "missing in b"} and len(got) == len(rows)
    assert (20, "missing in a") in statuses(audit(spark, b, a))


def test_many_shards_and_repeated_rows(spark):
    rows = pages(80) + [(5, "http://h5/5", "again", "x"), (5, "http://h5/5", "again", "x")]
    a, b = replicas(spark, rows, rows, shard_bytes=100)
    assert audit(spark, a, b).filter("status = 'same'").count() == len(rows)


def record(name, payload, size=None):
    return b"WARC/1.0\r\nWARC-Record-ID: <%s>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (name, len(payload) if size is None else size, payload)


def test_parse_finds_the_next_record_after_damage():
    data = record(b"a", b"x\r\n\r\ny") + record(b"b", b"zz", 7) + record(b"c", b"") + b"rest"
    got = [(data[first:stop], name) for first, stop, name, _ in parse(data)]
    assert [name for _, name in got] == ["<a>", None, "<c>", None]
    assert b"".join(part for part, _ in got) == data


@pytest.mark.parametrize("cut", [0, 1, 30, 200])
def test_cut_streams(cut):
    data = b"".join(record(b"%d" % i, bytes(range(256)) * i) for i in range(20))
    packed = gzip.compress(data)
    assert data.startswith(inflated(packed[: len(packed) - cut]))
    assert inflated(b"nonsense") == b"" and [len(x) for x in tree(b"")] == [0] * 6


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    a = write_replica(shard_records(empty), new_path(spark, "warc"))
    assert audit(spark, a, a).count() == 0
    rows = pages(5)
    b = write_replica(shard_records(spark.createDataFrame(rows, "page_id long, url string, html string, shard string")), new_path(spark, "warc"))
    assert {s for _, s in statuses(audit(spark, b, a))} == {"missing in b"}


def shard_sizes(records):
    return [r["n"] for r in records.groupBy("shard").agg(F.sum(F.octet_length("record") + 4).alias("n")).collect()]


def test_no_shard_holds_all_copies_of_a_page(spark):
    """A third of all rows are one page, others one id with many texts; both orders give the same shards."""
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 9, "x") for i in range(2000)] + [(7, "http://h/7", "<p>again</p>", "x")] * 1500
    rows += [(None, None, f"<p>lost {i % 400}</p>", "x") for i in range(500)]
    schema = "page_id long, url string, html string, shard string"
    records = [shard_records(spark.createDataFrame(x, schema), shard_bytes=40_000) for x in (rows, list(reversed(rows)))]
    assert max(shard_sizes(records[0])) <= 80_000 and sum(shard_sizes(records[0])) > 1_000_000
    assert records[0].exceptAll(records[1]).count() == 0 and records[0].count() == records[1].count() == len(rows)
    a, b = (write_replica(x, new_path(spark, "warc")) for x in records)
    assert damaged_leaves(replica_tree(spark, a), replica_tree(spark, b)) is None
    damaged = write_replica(records[0].withColumn("record", F.expr("replace(record, 'p>3<', 'p>4<')")), new_path(spark, "warc"))
    found = audit(spark, a, damaged).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in found} == {"same": len(rows) - 1, "damaged in b": 1}


def test_rows_without_payload_fill_shards(spark):
    rows = spark.range(3000).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    assert max(shard_sizes(shard_records(rows, shard_bytes=20_000))) <= 40_000
    nothing = rows.withColumn("page_id", F.lit(None).cast("long"))
    records = shard_records(nothing, shard_bytes=20_000)
    assert max(shard_sizes(records)) <= 40_000 and records.count() == 3000
