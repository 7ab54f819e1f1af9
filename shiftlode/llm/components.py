"""Connected components of a table of edges, by large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.session import settle

ROUNDS = 60  # far above the logarithm of any diameter


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (the smallest id of its component) of all ids in edges ``a``, ``b``; edges may repeat and are best
    stored, since the first round reads them more than once.

    Each round hangs the larger neighbours of an id, then its smaller ones, on the smallest
    id it knows; after a number of rounds that grows with the logarithm of the longest chain
    only stars are left. The smallest and largest neighbours that a round starts from show it: an id with a smaller
    neighbour then has no other, so no round is needed to see that nothing moves. Ids meet their smallest neighbour by an
    aggregate that combines before the shuffle and a join that Spark can split (the smallest neighbours are read from a
    stored table), so an id with very many neighbours is no hot spot. After that step an id has few smaller neighbours.
    """
    start = F.least("a", "b"), F.greatest("a", "b")
    links = edges.filter("a <> b").select(start[0].alias("v"), start[1].alias("u"))
    for _ in range(ROUNDS):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = settle(both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most")), "least")
        roots = near.select(F.col("u").alias("id"), F.least("least", "u").alias("root"))
        if near.filter("least < u AND least < most").isEmpty():
            return roots
        large = links.join(roots.toDF("v", "m"), "v").select("u", F.col("m").alias("v")).distinct()
        met = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = met.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v")
        links = settle(small.distinct(), "stars")
    raise RuntimeError("components did not settle")
