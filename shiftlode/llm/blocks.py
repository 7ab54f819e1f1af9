"""Nearest neighbours as a join of matrix blocks.

Queries and candidates are dealt by hash into blocks, and every query block meets every stripe of
candidates once (a stated set of queries against all rows). A tile of the two works in int8:

1. Unit vectors ``u`` are rounded to ``scale * code`` with codes in -127..127; the length
   ``e`` of what rounding lost is kept per vector.
2. The product of the codes gives every cosine within
   ``e_u * (1 + e_v) + e_v`` (plus a slack for double arithmetic).
3. A pair survives unless its upper bound is below the ``k``-th best lower bound that its query
   has. No pair among the true ``k`` nearest can be lost.
4. Survivors are computed in double precision from the original vectors, in index order, and go
   through a heap of ``k`` per query. The heaps of the tiles are merged by rank.

Blocks have about ``QUERIES`` and ``STRIPE`` rows, so a tile fits in a task whatever the size of the table. A candidate
is sent once per block of queries, in single precision where the table holds it so (that loses nothing); the double vectors
exist in the tile only. Sending codes alone would save more, but then all survivors of a tight cluster, a third of
all rows perhaps, would have to leave the tile instead of one heap per query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part; nor do rows without id. Vectors of another length than the query's are not compared. A
candidate with the id of the query is the query's own row. Of repeated query ids the smallest
vector searches; repeated candidates are candidates each. Ties go to the smaller id. An empty table
gives an empty result; other columns are ignored.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERIES = 4096
STRIPE = 4096
STEP = 512  # candidates of a tile that are multiplied at once
SLACK = 1e-9
RESULT = "query_id long, vec_id long, score double"


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id``, ``v`` and ``n`` (length) of the rows that take part; vectors of single precision stay so."""
    kind = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    v = F.col("v")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.withColumn("n", F.size(v))


class Block:
    """Vectors with their codes, scales and rounding errors."""

    def __init__(self, ids, vectors):
        self.ids = np.asarray(ids, np.int64)
        raw = np.array(list(vectors), np.float64)
        # A power of two changes no cosine and keeps squares in range.
        self.vectors = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
        self.norms = np.sqrt(in_order(self.vectors * self.vectors))
        unit = self.vectors / self.norms[:, None]
        self.scales = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.scales[:, None])
        self.lost = np.sqrt(((unit - codes * self.scales[:, None]) ** 2).sum(axis=1))
        self.codes = codes.astype(np.int8)


def in_order(products: np.ndarray) -> np.ndarray:
    """Sums along the last axis from the first to the last term."""
    return np.cumsum(products, axis=-1)[..., -1]


def tile(queries: Block, candidates: Block, k: int) -> Iterator[tuple[int, int, float]]:
    """The ``k`` best candidates of every query of a tile."""
    # Products of codes are whole numbers; below 2**24 single precision holds them exactly.
    kind = np.float32 if queries.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    left = queries.codes.astype(kind)
    best = np.full((len(queries.ids), k), -np.inf)  # the best lower bounds so far
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
    for start in range(0, len(candidates.ids), STEP):
        part = slice(start, start + STEP)
        ids, lost = candidates.ids[part], candidates.lost[part]
        near = (left @ candidates.codes[part].astype(kind).T).astype(np.float64)
        near *= queries.scales[:, None] * candidates.scales[None, part]
        error = queries.lost[:, None] * (1 + lost) + lost + SLACK
        own = queries.ids[:, None] == ids
        best = np.partition(np.hstack([best, np.where(own, -np.inf, near - error)]), -k, axis=1)[:, -k:]
        rows, columns = np.nonzero((near + error >= best.min(axis=1)[:, None]) & ~own)
        for at in range(0, len(rows), STEP):
            r, c = rows[at : at + STEP], columns[at : at + STEP] + start
            dots = in_order(queries.vectors[r] * candidates.vectors[c])
            scores = dots / (queries.norms[r] * candidates.norms[c])
            for row, number, score in zip(r.tolist(), candidates.ids[c].tolist(), scores.tolist()):
                heap, item = heaps[row], (score, -number)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
    for query, heap in zip(queries.ids.tolist(), heaps):
        for score, number in heap:
            yield query, -number, score


def nearest(
    df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    query_rows: int = QUERIES, stripe_rows: int = STRIPE,
) -> DataFrame:
    """The ``k`` nearest rows of every row for which the column ``is_query`` (over ``vec_id``) holds.

    Counts queries and rows first (two columns are read), for the number of blocks.
    """
    rows = valid_vectors(df, key, vector)
    wanted = rows.filter(is_query)
    all_rows, all_queries = df.select(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, stripes = -(-all_queries // query_rows) or 1, -(-all_rows // stripe_rows) or 1
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    candidates = rows.withColumn("_stripe", spread(stripes)).withColumn("_block", each(blocks))
    queries = wanted.groupBy("vec_id", "n").agg(F.min("v").alias("v"))
    queries = queries.withColumn("_block", spread(blocks)).withColumn("_stripe", each(stripes))
    tile_key = ["n", "_block", "_stripe"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = list(tile(Block(left["vec_id"], left["v"]), Block(right["vec_id"], right["v"]), k))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = queries.groupBy(*tile_key).cogroup(candidates.groupBy(*tile_key)).applyInPandas(run, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
