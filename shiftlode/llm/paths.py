"""Near copies by a chosen-path join of word shingles.

**Sets.** A text is the set of hashes of its runs of five words (all its words if it has fewer). Texts with equal
sets are one set from here on, so copies are never paired. A set is sketched by ``TOKENS`` sampled tokens:
the smallest hash under each of as many functions. Two sets share a sampled token with a probability
equal to their Jaccard similarity.

**Chosen paths.** A node of the recursion picks one or two of the sampled tokens (1 / similarity on average, by
a hash of the node), and every set goes to the child for its value of each. Similar sets stay together, others
part. Nodes with one set end; nodes with at most ``LIMIT`` sets are compared by brute force, and so are larger ones with at most ``BLOCK`` sets outside their main component; others are split
again, level by level, all runs at once. What is still large after ``DEPTH`` levels is compared in blocks, so no
bucket is cut. With similarity ``s`` a pair survives a level with the probability of :func:`survival`; the number of
runs follows from it and the target ``RECALL``. All runs read one sketch, so the miss is averaged over how many sampled
tokens a pair at the threshold shares (:func:`missed`).

**Links.** Brute force compares sketches; their error at the threshold is below 1e-5. What passes joins sets
into candidate components. Only connectivity counts there, so the first ``FIRST`` runs are settled first, each block of a large
node on its own; every set then carries the root of its component. In what is left, the blocks of those nodes against each other and the
other runs, only nodes with several roots go on, and only edges between different roots are sent: a group
of copies found once is not sent again by every run. The largest component of a node does not meet itself: its blocks meet
those of the other sets only (:func:`_root_tiles`), so the rows of a node grow with its sets times the blocks of the others. Within a component all pairs are compared, block by block, by sketch
and then exactly on the whole sets, so that every link is counted once, pairs that no run has found included.
Only counts and a spanning forest leave a tile, never pairs. Classes are the components of exact links.

Rows that move: sketches and node numbers (a few hundred bytes a set), and whole sets only of texts in a
candidate component, once per block of their component. Counts combine before the shuffle; sets meet
the size of their node by a join that Spark splits when a node is hot.

Defined cases: a text without words is its own class without links; null ids sort last when the class id (the
smallest id) is chosen; repeated rows have the same class; an empty table gives an empty table; other
columns are ignored by :func:`classes` and kept by :func:`first_rows`.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlode.llm.common import WordHashes, by_group, by_row, free_names, hashes_of, words_of
from shiftlode.llm.components import components
from shiftlode.session import settle

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
TOKENS = 128
FIRST = 4  # runs that are settled before the others
START = 2  # levels before the first count
DEPTH = 6
LIMIT = 256
BLOCK = 256
SLICE = 1 << 8
LINKED = 4  # blocks that a block of the exact comparison is as large as
HELD = 1 << 20  # tokens in such a block
SENT = 1 << 10  # sets whose nodes are computed at once
SLOTS = 1 << 22

_source = np.random.default_rng(20)
MULTIPLY = _source.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _source.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
PLACE = _source.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the runs of five words."""
    words = words_of(text)
    number = hashes_of(words, hashes)
    size = min(WORDS, len(words))
    if not size:
        return number
    total = np.full(len(words) - size + 1, size, np.uint64)
    for shift in range(size):
        total += number[shift : len(words) - size + 1 + shift] * PLACE[shift]
    total = mixed(total)
    total.sort()  # faster here than np.unique, which hashes first
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The sampled tokens of a set, 32 bits each."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    held = np.empty((TOKENS, min(SLICE, len(tokens))), np.uint64)
    for start in range(0, len(tokens), SLICE):
        own = tokens[start : start + SLICE]
        part = np.multiply(MULTIPLY[:, None], own, out=held[:, : len(own)])
        part += ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return mixed(least >> np.uint64(20)).astype("<u4")


def packed(own: np.ndarray) -> bytes:
    """A sketch as bytes: the lowest byte of every sampled token first, then the others."""
    return own.view(np.uint8).reshape(TOKENS, 4).T.tobytes()


def unpacked(column: pa.Array) -> np.ndarray:
    """Sketches of a column of :func:`packed` ones, one a row."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4, TOKENS)
    return np.ascontiguousarray(data.transpose(0, 2, 1)).view("<u4")[:, :, 0]


def survival(levels: int, similarity: float = SIMILARITY) -> float:
    """Probability that two sets are still in a common node after ``levels`` splits."""
    chance, two = 1.0, 1 / SIMILARITY - 1
    for _ in range(levels):
        part = 1 - similarity * chance
        chance = 1 - ((1 - two) * part + two * part * part)
    return chance


def missed(runs: int, similarity: float = SIMILARITY) -> float:
    """Probability that no run finds a pair; the runs are independent only given the sketches."""
    total = 0.0
    for matches in range(TOKENS + 1):
        chance = math.comb(TOKENS, matches) * similarity**matches * (1 - similarity) ** (TOKENS - matches)
        total += chance * (1 - survival(DEPTH, matches / TOKENS)) ** runs
    return total


def runs_for(recall: float = RECALL) -> int:
    runs = 1
    while missed(runs) > 1 - recall:
        runs += 1
    return runs


def split(nodes: np.ndarray, sketches: np.ndarray, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Children of sets in their nodes: place of the node, number of the child. ``owner`` is the row of ``sketches`` of each node."""
    rows = np.arange(len(nodes))
    draw = mixed(nodes ^ np.uint64(0x5851F42D4C957F2D))
    first = draw % np.uint64(TOKENS)
    again = mixed(draw)
    second = (first + np.uint64(1) + again % np.uint64(TOKENS - 1)) % np.uint64(TOKENS)
    twice = (mixed(again) >> np.uint64(11)) * 2.0**-53 < 1 / SIMILARITY - 1
    place = np.concatenate([rows, rows[twice]])
    chosen = np.concatenate([first, second[twice]])
    value = sketches[place if owner is None else owner[place], chosen.astype(np.int64)].astype(np.uint64)
    return place, mixed(nodes[place] + mixed((chosen << np.uint64(32)) | value))


def first_nodes(sketches: np.ndarray, runs: range) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of sets after the first levels of some runs: place of the set, number of the node."""
    owner = np.repeat(np.arange(len(sketches)), len(runs))
    nodes = np.tile(mixed(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64)), len(sketches))
    for _ in range(START):
        place, nodes = split(nodes, sketches, owner)
        owner = owner[place]
    return owner, nodes


def _started(sets: DataFrame, runs: range) -> DataFrame:
    """``node`` and ``sid`` of all sets after the first levels of some runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SENT):
                part = batch.slice(start, SENT)
                owner, nodes = first_nodes(unpacked(part.column(1)), runs)
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), part.column(0).take(pa.array(owner))], names=["node", "sid"])

    return sets.select("sid", "sketch").mapInArrow(run, "node long, sid binary")


def _children(large: DataFrame) -> DataFrame:
    """``node``, ``sid`` and ``root`` one level down, from the same columns and ``sketch``. The children of a set in a node differ."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes = np.array(batch.column(0).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                place, children = split(nodes, unpacked(batch.column(3)))
                others = [batch.column(i).take(pa.array(place)) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(children.view(np.int64)), *others], names=["node", "sid", "root"])

    return large.select("node", "sid", "root", "sketch").mapInArrow(run, "node long, sid binary, root binary")


def fewest_matches(tokens: int = TOKENS, similarity: float = SIMILARITY) -> int:
    """Sketches of a pair at the threshold share fewer tokens than this with probability below 1e-5."""
    total, matches = 0.0, 0
    while True:
        total += math.comb(tokens, matches) * similarity**matches * (1 - similarity) ** (tokens - matches)
        if total > 1e-5:
            return matches
        matches += 1


def _numbers(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).to_numpy()


def _briefs(group: pa.Table) -> np.ndarray:
    """One byte of every sampled token."""
    data = b"".join(group.column("brief").to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, TOKENS)


def _near(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """Pairs whose sketches and sizes allow the similarity."""
    small, large = np.minimum(left_size[:, None], right_size), np.maximum(left_size[:, None], right_size)
    near = small >= SIMILARITY * large - 1e-9
    rows = np.nonzero(near.any(axis=1))[0]
    fewest = fewest_matches()
    for at in range(0, len(rows), 32):
        part = rows[at : at + 32]
        near[part] &= np.count_nonzero(left[part, None, :] == right[None, :, :], axis=2) >= fewest
    return near


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, first member) that connect what a symmetric relation connects."""
    todo, edges = np.ones(len(near), bool), []
    for root in range(len(near)):
        if not todo[root]:
            continue
        reached = np.zeros(len(near), bool)
        fresh = np.zeros(len(near), bool)
        fresh[root] = True
        while fresh.any():
            reached |= fresh
            fresh = near[fresh].any(axis=0) & ~reached
        todo &= ~reached
        edges += [(member, root) for member in np.nonzero(reached)[0].tolist() if member != root]
    return edges


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Members of the two blocks of a tile; both are all members where a block meets itself."""
    block, low, high = (_numbers(group, name) for name in ("block", "low", "high"))
    return np.nonzero(block == low)[0], np.nonzero(block == high)[0]


def _relation(group: pa.Table) -> np.ndarray:
    """Symmetric matrix of pairs of a tile that may be similar."""
    brief, size = _briefs(group), _numbers(group, "size")
    left, right = _sides(group)
    near = np.zeros((len(size), len(size)), bool)
    near[np.ix_(left, right)] = _near(brief[left], brief[right], size[left], size[right])
    near |= near.T
    np.fill_diagonal(near, False)
    return near


def _candidate_edges(group: pa.Table) -> list[tuple]:
    """Edges that connect the components (roots) which the pairs of a tile connect, one less than the components."""
    roots = group.column("root").to_pylist()
    names, number = np.unique(np.array(roots, object), return_inverse=True)
    if len(names) < 2:
        return []
    rows, columns = np.nonzero(_relation(group))
    near = np.zeros((len(names), len(names)), bool)
    near[number[rows], number[columns]] = True
    return [(names[a], names[b]) for a, b in _forest(near | near.T)]


def _exact(near: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Keep the pairs whose whole sets are similar enough."""
    rows, columns = np.nonzero(np.triu(near))
    left, right = np.unique(rows), np.unique(columns)
    used = np.union1d(left, right)
    kept = np.zeros_like(near)
    if not len(rows):
        return kept
    place, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)[1:]
    several = times > 1  # tokens of one set are in no two
    every = int(several.sum())
    if len(rows) * 2e-5 > len(left) * len(right) * every * 1e-10:
        # Many pairs of like sets: common tokens as products of 0/1 matrices, some columns at a time.
        owner = np.repeat(used, [len(sets[i]) for i in used])
        met = several[place]
        owner, place = owner[met], (np.cumsum(several) - 1)[place[met]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        common = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, every, 4096):
            part = slice(*np.searchsorted(place, [start, start + 4096]))
            has = []
            for side in (left, right):
                at = np.minimum(np.searchsorted(side, owner[part]), len(side) - 1)
                own = side[at] == owner[part]
                has.append(np.zeros((len(side), 4096), np.float32))
                has[-1][at[own], place[part][own] - start] = 1
            common += has[0] @ has[1].T
        at = np.searchsorted(left, rows), np.searchsorted(right, columns)
        shared = common[at].astype(np.int64)
    else:
        shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(rows, columns)])
    size = np.array([len(x) for x in sets])
    good = shared >= SIMILARITY * (size[rows] + size[columns] - shared) - 1e-9
    kept[rows[good], columns[good]] = True
    return kept | kept.T


def _exact_links(group: pa.Table) -> list[tuple]:
    """Per member of a tile: texts that it links to, and an edge of the spanning forest."""
    sids = group.column("sid").to_pylist()
    if len(set(sids)) < len(sids):  # a set that was read from several equal rows
        group = group.take([sids.index(sid) for sid in dict.fromkeys(sids)])
    group = group.take(np.argsort(_numbers(group, "block"), kind="stable"))  # pairs go from one block to the other
    sids = group.column("sid").to_pylist()
    linked = _exact(_relation(group), [np.frombuffer(x, "<u8") for x in group.column("tokens").to_pylist()])
    texts = linked @ _numbers(group, "texts")
    parent = dict(_forest(linked))
    least = list(sids)  # of the members that hang on a member
    for member, root in parent.items():
        least[root] = min(least[root], sids[member])
    return [(sids[i], int(texts[i]), least[parent.get(i, i)]) for i in np.nonzero(texts)[0].tolist()]


def _meet(dealt: DataFrame, others: str) -> DataFrame:
    """Every member once per tile: with each of the first ``others`` blocks of its group."""
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)))
    return dealt.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))


def _tiles(members: DataFrame, size: str, tokens: str) -> DataFrame:
    """Deal members of a group (column ``grp``) into blocks of bounded numbers of sets and tokens; every two blocks of it meet in a tile."""
    blocks = F.greatest(F.ceil(F.col(size) / F.lit(LINKED * BLOCK)), F.ceil(F.col(tokens) / F.lit(HELD))).cast("long")
    return _meet(members.withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("_blocks"))), "_blocks")


def _blocks(size: F.Column) -> F.Column:
    return F.ceil(size / F.lit(BLOCK)).cast("long")


def _own_tiles(members: DataFrame, size: str) -> DataFrame:
    """Members of a group in blocks, each of which meets itself only."""
    blocks = F.when(F.col(size) > LIMIT, _blocks(F.col(size))).otherwise(F.lit(1).cast("long"))
    dealt = members.withColumn("block", F.pmod(F.xxhash64("sid"), blocks))
    return dealt.withColumn("low", F.col("block")).withColumn("high", F.col("block"))


def _root_tiles(members: DataFrame) -> DataFrame:
    """Tiles in which members of different roots of a group (sized by :func:`_sized`) meet.

    The root with the most members of a large group needs no tiles of its own: its blocks meet those of the others only, so
    a group that is one component but for a few sets moves about once.
    """
    rest, most = _blocks(F.col("rest")), _blocks(F.col("members") - F.col("rest"))
    own = F.xxhash64("sid")
    dealt = members.filter(F.col("members") > LIMIT).withColumn("_rest", rest).withColumn("_most", most)
    dealt = dealt.withColumn("block", F.when(F.col("main"), F.col("_rest") + F.pmod(own, F.col("_most"))).otherwise(F.pmod(own, F.col("_rest"))))
    met = _meet(dealt.withColumn("_others", F.when(F.col("main"), F.col("_rest")).otherwise(F.col("_rest") + F.col("_most"))), "_others")
    small = _own_tiles(members.filter(F.col("members") <= LIMIT), "members")
    return small.unionByName(met.select(*small.columns))


def _counted(members: DataFrame) -> DataFrame:
    """As :func:`_sized` without ``main``, where every set is its own root: no count by root is needed."""
    sizes = members.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1")
    return members.join(settle(sizes.withColumn("rest", F.col("members") - 1), "sizes"), "node")


def _sized(members: DataFrame) -> DataFrame:
    """Members of nodes that hold sets of at least two roots, with the size of the node (``members``), whether they are of
    its ``main`` root, the one with the most of them, and how many are not (``rest``)."""
    roots = members.groupBy("node", "root").agg(F.count("*").alias("n"))
    sizes = roots.groupBy("node").agg(F.sum("n").alias("members"), F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots"))
    sizes = sizes.filter("roots > 1").select("node", "members", F.col("most.root").alias("_root"), (F.col("members") - F.col("most.n")).alias("rest"))
    return members.join(settle(sizes, "sizes"), "node").withColumn("main", F.col("root") == F.col("_root")).drop("_root")


def _ended(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that are not split again, and the others. A large node with few members outside its main root ends too: these meet
    all of it in about as many rows as it has, where its next level would have more."""
    ends = (F.col("members") <= LIMIT) | (F.col("rest") <= BLOCK)
    return level.filter(ends), level.filter(~ends)


def _leaves(sets: DataFrame, runs: range, found: DataFrame | None = None) -> DataFrame:
    """Nodes where the recursion ends, with their sets and the roots of these (by ``found``: ``sid``, ``root``)."""
    start = _started(sets, runs)
    if found is None:
        sized, level = _counted, _counted(start.withColumn("root", F.col("sid")))
    else:
        shared = settle(start.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1").select("node"), "shared")
        met = settle(_rooted(start.join(shared, "node", "left_semi"), found), "met")  # most nodes hold one set
        sized, level = _sized, _sized(met)
    (leaves, large), own = _ended(settle(level, "nodes")), None
    for _ in range(START, DEPTH):
        large = settle(large.select("node", "sid", "root"), "large")
        if large.isEmpty():
            return leaves
        if own is None:  # sets in large nodes were in large ones a level before
            some = _sifted(sets.select("sid", "sketch"), F.xxhash64("sid"), large.select(F.xxhash64("sid")))
            own = settle(some.join(large.select("sid").distinct(), "sid", "left_semi"), "sketches")
        ended, large = _ended(settle(sized(settle(_children(large.join(own, "sid")), "children")), "nodes"))
        leaves = leaves.unionByName(ended)
    return leaves.unionByName(large)


def _rooted(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members with the root of their set, which is the set itself if none is known."""
    if found is None:
        return members.withColumn("root", F.col("sid"))
    return members.join(found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def _candidates(sets: DataFrame, known: DataFrame, runs: int) -> DataFrame:
    """Components (``id``, ``root``) of the sets that brute force in the leaves of all runs connects."""
    tile = ["grp", "low", "high"]
    columns = ["root", "brief", "size", "block", "low", "high"]

    def edges(members: DataFrame) -> DataFrame:
        return by_group(members, tile, columns, _candidate_edges, "a binary, b binary")

    def described(leaves: DataFrame) -> DataFrame:
        return leaves.join(known, "sid").withColumn("grp", F.col("node"))

    first = settle(_leaves(sets, range(min(FIRST, runs))), "first")
    found = settle(components(settle(edges(_own_tiles(described(first), "members")).distinct(), "edges")), "found")
    rooted = found.withColumnRenamed("id", "sid")

    # Nodes of one block are done; of larger ones the blocks still have to meet.
    large = _sized(_rooted(first.filter(F.col("members") > LIMIT).select("node", "sid"), rooted))
    rest = large.unionByName(_leaves(sets, range(FIRST, runs), rooted)) if runs > FIRST else large  # nodes of different runs differ
    later = settle(edges(_root_tiles(settle(described(rest), "described"))), "later")
    if later.isEmpty():
        return found
    return settle(components(later.unionByName(found.select(F.col("id").alias("a"), F.col("root").alias("b")))), "candidates")


def _described(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row with its id, hash of its text, set id, size and sketch of its set."""

    def step():
        hashes = WordHashes()

        def one(number, tie, value):
            tokens = shingles(value, hashes)
            if not len(tokens):
                return [(number, tie, None, 0, None)]
            return [(number, tie, xxhash.xxh128_digest(tokens.tobytes()), len(tokens), packed(sketch(tokens)))]

        return one

    rows = df.select(F.col(key).cast("long").alias("_key"), F.xxhash64(F.col(text)).alias("_tie"), F.col(text).alias("_text"))
    return by_row(rows, ["_key", "_tie", "_text"], step, "_key long, _tie long, sid binary, size long, sketch binary")


def _grouped(df: DataFrame, key: str, text: str, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their set, and sets with class, links and the row that stands for the class."""
    described = settle(_described(df, key, text), "shingles")
    some = described.filter("sid IS NOT NULL")
    texts = some.groupBy("sid", "_tie").agg(F.min(F.struct(F.col("_key").isNull().alias("_no"), "_key", "_tie")).alias("first"))
    texts = texts.groupBy("sid").agg(F.min("first").alias("first"), F.count("*").alias("texts"))
    sketches = some.groupBy("sid").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    sets = settle(texts.join(sketches, "sid"), "sets")

    known = sets.select("sid", "size", "texts", "first", F.substring("sketch", 1, TOKENS).alias("brief"))
    found = _candidates(sets, known, runs_for(recall))

    chosen = settle(found.withColumnRenamed("id", "sid").join(known, "sid"), "chosen")
    sizes = chosen.groupBy("root").agg(F.count("*").alias("members"), F.sum("size").alias("held"))
    whole = _whole_sets(df, chosen, key, text)
    members = chosen.join(sizes, "root").withColumn("grp", F.xxhash64("root")).join(whole, "sid")
    members = _tiles(members, "members", "held")
    columns = ["sid", "brief", "size", "texts", "block", "low", "high", "tokens"]
    links = settle(by_group(members, ["grp", "low", "high"], columns, _exact_links, "sid binary, links long, other binary"), "links")

    roots = components(links.select(F.col("sid").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("sid").agg(F.sum("links").alias("links"))
    joined = sets.select("sid", "first", "texts").join(counts, "sid", "left").join(roots.withColumnRenamed("id", "sid"), "sid", "left")
    joined = settle(joined.withColumn("root", F.coalesce("root", "sid")), "classes")
    first = joined.groupBy("root").agg(F.min("first").alias("class"))
    number = (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("n_links")
    return described, joined.join(first, "root").select("sid", "class", number)


def _sifted(rows: DataFrame, number: F.Column, wanted: DataFrame) -> DataFrame:
    """Rows whose number may be one of the wanted ones (one column), so that a join need not move the others.

    Numbers are compared by slot; at most ``SLOTS`` whole numbers go to all tasks, however many are wanted.
    """
    slots = wanted.select(F.pmod(F.col(f"`{wanted.columns[0]}`"), F.lit(SLOTS)).cast("int").alias("_slot")).distinct()
    return rows.withColumn("_at", F.pmod(number, F.lit(SLOTS)).cast("int")).join(F.broadcast(slots), F.col("_at") == F.col("_slot"), "left_semi").drop("_at")


def _whole_sets(df: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """All tokens of the chosen sets, from the text of one row each."""

    def step():
        hashes = WordHashes()
        return lambda sid, value: [(sid, shingles(value, hashes).tobytes())]

    wanted = settle(chosen.select("sid", F.col("first._key").alias("_key"), F.col("first._tie").alias("_tie")), "wanted")
    rows = df.select(F.col(key).cast("long").alias("_own"), F.col(text).alias("_text"))
    rows = _sifted(rows, F.xxhash64("_text"), wanted.select("_tie"))
    met = rows.join(wanted, F.col("_own").eqNullSafe(F.col("_key")))
    met = met.filter(F.xxhash64("_text") == F.col("_tie"))
    return settle(by_row(met, ["sid", "_text"], step, "sid binary, tokens binary"), "tokens")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """Per row its class (the smallest id in it) and its number of links to other texts.

    Links go to different texts; further copies of the same text add none.
    """
    rows, sets = _grouped(df, key, text, recall)
    joined = rows.select("_key", "sid").join(sets, "sid", "left")
    return joined.select(
        F.col("_key").alias(key),
        F.when(F.col("sid").isNull(), F.col("_key")).otherwise(F.col("class._key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def first_rows(df: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row of each class, with all columns: the one with the smallest id. Texts without words all stay."""
    rows, sets = _grouped(df, key, text, recall)
    stay = sets.select("class").distinct().select(F.col("class._key").alias("_key"), F.col("class._tie").alias("_tie"))
    # How often the row that stays is there: repeated rows are numbered, others do not move again.
    many = rows.filter("sid IS NOT NULL").groupBy("_key", "_tie").agg(F.count("*").alias("_rows"))
    same = many["_key"].eqNullSafe(stay["_key"]) & (many["_tie"] == stay["_tie"])
    stay = stay.join(many, same).select(stay["_key"], stay["_tie"], "_rows")
    wordless = rows.filter("sid IS NULL").groupBy("_key", "_tie").agg(F.lit(1).cast("long").alias("_rows"))
    own, tie, number, place = free_names(df, "_key", "_tie", "_rows", "_place")
    stay = settle(stay.unionByName(wordless).toDF(own, tie, number), "stay")
    joined = df.join(stay, df[key].cast("long").eqNullSafe(stay[own]) & (F.xxhash64(df[text]) == stay[tie]))
    columns = [F.col(f"`{name}`") for name in df.columns]
    order = Window.partitionBy(own, tie).orderBy(*[F.col(f"`{c}`") for c in df.columns if c not in (key, text)], F.lit(1))
    repeated = joined.filter(F.col(number) > 1).withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1)
    return joined.filter(F.col(number) == 1).select(*columns).unionByName(repeated.select(*columns))
