"""WARC shards and a fixity audit of two replicas by hash trees.

**Writing.** Records (header lines, blank line, payload, two line ends) go to shards of at most about ``SHARD_BYTES``
bytes, dealt by hash and ordered by id, as gzipped text files that Spark writes itself. Each header has the digest
of its payload. The number of shards is a power of two from the bytes of the whole records. Rows of one id and address share a
shard while they are at most a ``PARTS``-th of it; else they are dealt by their content, and copies of one row in
runs of that size, counted by Spark: which shard holds how many copies depends on the rows only, not on their order.

**Trees.** A task reads whole shards. A leaf is the hash of a record with the range of offsets it
fills; a node is the hash of up to ``FAN`` ordered children with the range they cover; ``LEVELS`` levels give the root
of a shard, and Spark goes on over the shards to the root of the replica.

**Audit.** If the roots are equal nothing else is read. Otherwise the two trees are compared level by level, and only
children of nodes that differ are looked at: with few damaged records a few rows per level. Leaves that differ
are matched by record id, so that records which only moved are told from damaged and missing ones; the
digest in the header says which of two copies is damaged.

A record is ``same``, ``moved`` (same bytes elsewhere), ``damaged in a``, ``b`` or ``both``, ``differs`` (both sound),
``missing in a`` or ``missing in b``.

Defined cases: null html is an empty payload, a null url no address line, line ends in urls are
escaped; records with equal ids are told apart by their order in the shard; bytes that are no record
are a leaf without id; a stream that ends in the middle gives the records before; an empty table has no shards
and an empty audit; other columns are ignored.
"""

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode.llm.common import arrow_types, to_batch, values
from shiftlode.session import new_path, settle

SHARD_BYTES = 8 << 20
PARTS = 8
HEADER = 320  # bytes of a record beside its address and payload, at most
FAN, LEVELS = 16, 5  # up to FAN ** LEVELS records a shard
BEGIN, END = b"WARC/1.0\r\n", b"\r\n\r\n"
NODES = "level int, shard long, idx long, first long, stop long, hash binary, record string, sound boolean, digest binary"


def records_text(key, url, html) -> F.Column:
    """One WARC record without its two closing line ends."""
    payload = F.coalesce(html.cast("string"), F.lit(""))
    address = F.regexp_replace(F.regexp_replace(url.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:row:"),
        F.coalesce(key.cast("string"), F.lit("null")),
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), address, F.lit("\r\n")), F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\nWARC-Block-Digest: sha256:"),
        F.sha2(payload, 256),
        F.lit("\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"),
        payload,
    )


def shard_records(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``shard``, ``_order`` and ``record`` of every row; counts bytes by id and address first."""
    rows = df.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    size = F.lit(HEADER).cast("long") + sum(F.coalesce(F.octet_length(name), F.lit(0)) for name in ("_url", "_html"))
    most = max(1, shard_bytes // PARTS)
    sizes = rows.groupBy("_key", "_url").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    sizes = settle(sizes, "record-sizes")
    total = sizes.agg(F.sum("_bytes")).first()[0] or 0
    shards = 1 << (max(1, -(-total // shard_bytes)) - 1).bit_length()
    record = records_text(F.col("_key"), F.col("_url"), F.col("_html"))
    number = F.col("_key").cast("long").alias("_order")

    def dealt(*by: str) -> F.Column:
        return F.pmod(F.xxhash64(*by), F.lit(shards)).alias("shard")

    large = sizes.filter((F.col("_rows") > 1) & (F.col("_bytes") > most)).select(F.col("_key").alias("_k"), F.col("_url").alias("_u"))
    if shards == 1 or not large.take(1):
        return rows.select(dealt("_key", "_url"), number, record.alias("record"))
    large = settle(large, "large-ids")
    same = F.col("_key").eqNullSafe(F.col("_k")) & F.col("_url").eqNullSafe(F.col("_u"))
    small = rows.join(large, same, "left_anti").select(dealt("_key", "_url"), number, record.alias("record"))
    # One row for all copies, then one for each run of them, which moves before it becomes records.
    copies = rows.join(large, same, "left_semi").groupBy("_key", "_url", "_html").agg(F.count("*").alias("_n"))
    copies = copies.withColumn("_run", F.greatest(F.lit(1).cast("long"), F.floor(F.lit(most) / size)))
    runs = copies.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / F.col("_run")))))
    runs = runs.select(dealt("_key", "_url", "_html", "_at"), number, record.alias("record"), F.least("_run", F.col("_n") - F.col("_at") * F.col("_run")).alias("_times"))
    each = runs.repartition("shard").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return small.unionByName(each.select("shard", "_order", "record"))


def write_replicas(records: DataFrame, target: str, copies: dict[str, F.Column]) -> list[str]:
    """Folders with one replica for each of ``copies``, a name and the record that it holds.

    The rows move to their shard once for all replicas; a task writes the file of a shard in the order of ``_order``.
    """
    each = [F.struct(F.lit(name).alias("replica"), record.alias("value")) for name, record in copies.items()]
    placed = records.repartition("shard").select("shard", "_order", F.explode(F.array(*each)).alias("_copy"))
    lines = placed.select("_copy.replica", "shard", "_order", "_copy.value")
    lines = lines.sortWithinPartitions("replica", "shard", "_order", "value").drop("_order")
    lines.write.partitionBy("replica", "shard").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(target)
    return [f"{target}/replica={name}" for name in copies]


def write_replica(records: DataFrame, target: str) -> str:
    """The folder of a single replica."""
    return write_replicas(records, target, {"only": F.col("record")})[0]


def inflated(data: bytes) -> bytes:
    """All that can be read of a gzip stream."""
    out = []
    while data:
        stream = zlib.decompressobj(31)
        try:
            out.append(stream.decompress(data))
        except zlib.error:
            return b"".join(out)
        data = stream.unused_data
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[int, int, str | None, bool]]:
    """First and last offset, id, and whether the payload has the digest of its header."""
    at = 0
    while at < len(data):
        stop, name, sound = -1, None, False
        head = data.find(END, at)
        if data.startswith(BEGIN, at) and head > 0:
            fields = dict(line.partition(b":")[::2] for line in data[at + len(BEGIN) : head].split(b"\r\n"))
            size = fields.get(b"Content-Length", b"").strip()
            if size.isdigit():
                first, last = head + len(END), head + len(END) + int(size)
                if data[last : last + len(END)] == END:
                    stop = last + len(END)
                    name = fields.get(b"WARC-Record-ID", b"").strip().decode("utf-8", "replace")
                    sound = fields.get(b"WARC-Block-Digest", b"").strip() == b"sha256:" + hashlib.sha256(data[first:last]).hexdigest().encode()
        if stop < 0:  # no record: up to where the next one begins
            found = data.find(END + BEGIN, at)
            stop = found + len(END) if found >= 0 else len(data)
        yield at, stop, name, sound
        at = stop


def tree(data: bytes) -> list[list[tuple]]:
    """Levels of the tree of a shard: (first, stop, hash, id, sound, digest) for leaves, without the last three above."""
    leaves, seen = [], {}
    for first, stop, name, sound in parse(data):
        digest = hashlib.sha256(data[first:stop]).digest()
        if name is not None:
            seen[name] = seen.get(name, 0) + 1
            name = name if seen[name] == 1 else f"{name}#{seen[name]}"
        leaves.append((first, stop, hashlib.sha256(b"\0" + struct.pack("<QQ", first, stop) + digest).digest(), name, sound, digest))
    if len(leaves) > FAN**LEVELS:
        raise ValueError("a shard has too many records; take smaller shards")
    levels = [leaves]
    for _ in range(LEVELS):
        below = levels[-1]
        parts = [below[at : at + FAN] for at in range(0, len(below), FAN)]
        levels.append([node(part) for part in parts])
    return levels


def node(children: list[tuple]) -> tuple:
    first, stop = children[0][0], children[-1][1]
    inner = b"".join(child[2] for child in children)
    return first, stop, hashlib.sha256(b"\1" + struct.pack("<QQ", first, stop) + inner).digest(), None, None, None


def replica_tree(spark: SparkSession, source: str) -> DataFrame:
    """All nodes of a replica below the roots of its shards, written by level."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [field.split()[0] for field in NODES.split(", ")], arrow_types(NODES)
        for batch in batches:
            for shard, content in zip(values(batch.column(0)), values(batch.column(1))):
                for level, nodes in enumerate(tree(inflated(content))):
                    for at in range(0, len(nodes), 1 << 12):
                        rows = [(level, shard, at + i, *x) for i, x in enumerate(nodes[at : at + (1 << 12)])]
                        yield to_batch(rows, names, types)

    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], NODES)  # no records, no folder
    target = new_path(spark, "tree")
    shards = files.select(F.col("shard").cast("long"), "content")
    shards.mapInArrow(run, NODES).write.partitionBy("level").parquet(target)
    return spark.read.schema(NODES).parquet(target)


def _above(level: DataFrame) -> DataFrame:
    """Parents of nodes that are numbered by ``idx`` (over the shards)."""
    children = level.groupBy(F.floor(F.col("idx") / FAN).alias("idx")).agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("c"))
    joined = F.array_join(F.transform("c", lambda x: F.concat(x["idx"].cast("string"), F.lit(":"), F.hex(x["hash"]))), ",")
    return children.select(F.lit(-1).cast("long").alias("shard"), "idx", F.unhex(F.sha2(joined, 256)).alias("hash"))


def _upper(nodes: DataFrame) -> list[DataFrame]:
    """Levels over the shards, the root of the replica last."""
    roots = nodes.filter(F.col("level") == LEVELS).select(F.lit(-1).cast("long").alias("shard"), F.col("shard").alias("idx"), "hash")
    levels = [roots]
    most = (roots.agg(F.max("idx")).first()[0] or 0) + 1
    while most > 1 or len(levels) == 1:
        levels.append(settle(_above(levels[-1]), "tree-top"))
        most = -(-most // FAN)
    return levels


def _differing(a: DataFrame, b: DataFrame, parents: DataFrame | None, parent) -> DataFrame:
    """Keys of nodes that are not equal in both, below ``parents``."""
    sides = []
    for side, name in ((a, "a"), (b, "b")):
        side = side.select("shard", "idx", F.col("hash").alias(name))
        if parents is not None:
            up = parents.select(F.col("shard").alias("_s"), F.col("idx").alias("_i"))
            side = side.join(up, (parent[0] == up["_s"]) & (parent[1] == up["_i"]), "left_semi")
        sides.append(side)
    met = sides[0].join(sides[1], ["shard", "idx"], "full")
    return settle(met.filter(~F.col("a").eqNullSafe(F.col("b"))).select("shard", "idx"), "differing")


def damaged_leaves(a: DataFrame, b: DataFrame) -> DataFrame | None:
    """Keys (shard, idx) of leaves that are not equal; nothing if the roots are."""
    tops = _upper(a), _upper(b)
    height = max(map(len, tops))
    for levels in tops:  # a replica without the last shards may have a lower tree
        while len(levels) < height:
            levels.append(_above(levels[-1]))
    if [r[0] for r in tops[0][-1].select("hash").collect()] == [r[0] for r in tops[1][-1].select("hash").collect()]:
        return None
    found = None
    number = F.col("idx")
    for left, right in zip(reversed(tops[0]), reversed(tops[1])):
        found = _differing(left, right, found, (F.lit(-1).cast("long"), F.floor(number / FAN)))
    found = found.select(F.col("idx").alias("shard"), F.lit(0).cast("long").alias("idx"))
    for level in range(LEVELS - 1, -1, -1):
        sides = [side.filter(F.col("level") == level) for side in (a, b)]
        found = _differing(*sides, found, (F.col("shard"), F.floor(number / FAN)))
    return found


def audit(spark: SparkSession, first: str, second: str) -> DataFrame:
    """One row per record of either replica: id, shard, place in the first (or second) replica, status."""
    a, b = replica_tree(spark, first), replica_tree(spark, second)
    leaf = [side.filter("level = 0") for side in (a, b)]
    columns = ["record", "shard", "first", "stop"]
    found = damaged_leaves(a, b)
    if found is None:
        return leaf[0].select(*columns, F.lit("same").alias("status"))
    same = leaf[0].join(found, ["shard", "idx"], "left_anti").select(*columns, F.lit("same").alias("status"))
    left, right = (
        side.join(found, ["shard", "idx"], "left_semi").select(*[F.col(c).alias(f"{name}_{c}") for c in [*columns, "sound", "digest"]])
        for side, name in zip(leaf, "ab")
    )
    met = left.join(right, (F.col("a_shard") == F.col("b_shard")) & (F.col("a_record") == F.col("b_record")), "full")
    status = (
        F.when(F.col("b_shard").isNull(), F.when(F.col("a_record").isNull(), "damaged in a").otherwise("missing in b"))
        .when(F.col("a_shard").isNull(), F.when(F.col("b_record").isNull(), "damaged in b").otherwise("missing in a"))
        .when(F.col("a_digest") == F.col("b_digest"), "moved")
        .when(F.col("a_sound") & F.col("b_sound"), "differs")
        .when(F.col("a_sound"), "damaged in b")
        .when(F.col("b_sound"), "damaged in a")
        .otherwise("damaged in both")
    )
    return same.unionByName(met.select(*[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in columns], status.alias("status")))


def row_id(record) -> F.Column:
    """Id of the row that a record was written from."""
    return F.regexp_extract(record, r"^<urn:row:(-?\d+)>", 1).try_cast("long")
