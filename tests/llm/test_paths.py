"""Classes and links against brute force; buckets of every size; graphs of every shape."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftlode.llm import components as module
from shiftlode.llm import paths
from shiftlode.llm.common import WordHashes
from shiftlode.llm.components import components
from shiftlode.llm.paths import classes, first_rows, fewest_matches, runs_for, shingles, sketch, survival


def grams(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> class id, links."""
    sets = [grams(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                root[find(i)] = find(j)
                if rows[i][1] != rows[j][1]:
                    links[i].add(rows[j][1])
                    links[j].add(rows[i][1])
    least = {}
    for i, (number, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 62 if number is None else number)
    return sorted((number is None, number, None if least[find(i)] == 1 << 62 else least[find(i)], len(links[i])) for i, (number, _) in enumerate(rows))


def collection(seed=3):
    source = np.random.default_rng(seed)
    word = lambda: "w%d" % source.integers(0, 4000)
    shared = [word() for _ in range(60)]
    rows = []
    for group in range(60):
        base = [word() for _ in range(int(source.integers(3, 260)))]
        if group % 3 == 0:
            base = shared + base[:80]
        for _ in range(int(source.integers(1, 7))):
            copy = list(base)
            for _ in range(int(source.integers(0, max(2, len(base) // 30)))):
                copy[int(source.integers(0, len(copy)))] = word()
            rows.append((len(rows), (" " if source.random() < 0.5 else "\n").join(copy)))
    base = [word() for _ in range(150)]
    for i in range(150):  # a large group of near copies
        copy = list(base)
        copy[int(source.integers(0, 150))] = word()
        rows.append((1000 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("limit, block", [(256, 512), (8, 16)])
def test_equals_brute_force(spark, monkeypatch, limit, block):
    monkeypatch.setattr(paths, "LIMIT", limit)
    monkeypatch.setattr(paths, "BLOCK", block)
    rows = collection()
    rows += [(5000 + i, rows[5][1]) for i in range(40)]
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "one two"), (6004, "one\ttwo"), (6005, "one three"), (6006, "x " * 9000)]
    rows += [(6007, "x " * 9000 + "y"), (6008, "x"), (6008, "x"), (6009, " ".join(f"v{i}" for i in range(30_000)))]
    df = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, size int")
    got = sorted((r[0] is None, *r) for r in classes(df).collect())
    assert got == brute(rows)


def test_first_rows(spark):
    rows = collection(4)
    extra = [(3000, rows[0][1]), (0, rows[0][1]), (3001, None), (3001, None), (3002, ""), (None, "only null id here and there"), (None, rows[0][1])]
    df = spark.createDataFrame([(*row, "k") for row in rows + extra], "doc_id long, text string, _rows string")
    kept = first_rows(df)
    assert kept.columns == df.columns
    expected = [*{c for _, _, c, _ in brute(rows)}, 3001, 3001, 3002, None]
    got = [row["doc_id"] for row in kept.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert first_rows(df.limit(0)).count() == 0 and classes(df.limit(0)).count() == 0


def test_survival_and_runs():
    assert 0.7 < survival(2) < 0.75 and survival(2, 0.3) < 0.15
    assert (1 - survival(paths.DEPTH)) ** runs_for(0.995) <= 0.005
    assert 60 < fewest_matches() < 90


def test_recursion_finds_pairs_at_the_threshold():
    """Share of pairs at the threshold that meet in a node after all levels, over many pairs."""
    source, met = np.random.default_rng(1), 0
    for _ in range(200):
        tokens = source.integers(0, 1 << 63, 110, dtype=np.uint64)
        pair = np.stack([sketch(np.unique(tokens[:99])), sketch(np.unique(tokens[11:]))])
        found = []
        for own in pair:
            nodes = paths.mixed(np.arange(1, runs_for() + 1, dtype=np.uint64))
            for _ in range(paths.DEPTH):
                nodes = paths.split(nodes, np.broadcast_to(own, (len(nodes), paths.TOKENS)))[1]
            found.append(set(nodes.tolist()))
        met += bool(found[0] & found[1])
    assert met >= 190  # the tokens are sampled once for all runs


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_shingles(words):
    text = b" ".join(words).decode()
    assert len(shingles(text, WordHashes())) == len(grams(text))


@pytest.mark.parametrize("shape", ["chain", "star", "ring", "random", "none"])
def test_components(spark, shape):
    source = np.random.default_rng(8)
    n = 120
    order = source.permutation(n).tolist()
    edges = {
        "chain": [(order[i], order[i + 1]) for i in range(n - 1)],
        "star": [(77, i) for i in range(n)],
        "ring": [(order[i], order[(i + 1) % n]) for i in range(n)],
        "random": source.integers(0, n, (60, 2)).tolist(),
        "none": [],
    }[shape]
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {(a, label[a]) for a, b in edges for a in (a, b) if edges and any(x != y for x, y in edges if a in (x, y))}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_runs_are_enough_for_pairs_of_one_sketch():
    """Pairs at the threshold with sampled tokens drawn at random; all runs of a pair read the same ones."""
    assert paths.missed(runs_for(0.995)) <= 0.005 and paths.missed(runs_for()) <= 1e-4
    source = np.random.default_rng(3)
    shared = source.binomial(paths.TOKENS, paths.SIMILARITY, 200_000) / paths.TOKENS
    chances = {x: survival(paths.DEPTH, x) for x in np.unique(shared)}
    found = np.array([chances[x] for x in shared])
    assert ((1 - found) ** runs_for()).mean() <= 2e-4


@pytest.mark.parametrize("strays", [1, 40, 700])
def test_rows_of_tiles_grow_with_the_members(spark, strays):
    """A node that is one component but for some sets: every pair of different roots meets once, rows grow with the members."""
    made = {}
    for size in (2000, 4000):
        rows = [(7, b"%05d" % i, b"%05d" % i if i < strays else b"main", 1) for i in range(size)] + [(8, b"a", b"a", 1), (8, b"b", b"b", 1), (9, b"c", b"x", 1), (9, b"d", b"x", 1)]
        sized = paths._sized(spark.createDataFrame(rows, "node long, sid binary, root binary, size long"))
        tiles = paths._root_tiles(sized.withColumn("grp", F.col("node"))).select("grp", "sid", "root", "block", "low", "high").collect()
        assert {r["grp"] for r in tiles} == {7, 8}
        met = {}
        for r in tiles:
            met.setdefault((r["grp"], r["low"], r["high"]), []).append(r)
        blocks = {}
        for r in tiles:
            blocks.setdefault((r["grp"], bytes(r["sid"])), (bytes(r["root"]), r["block"]))
        of = {}
        for (grp, _), (root, block) in blocks.items():
            of.setdefault((grp, block), set()).add(root)
        for (grp, a), left in of.items():
            for (other, b), right in of.items():
                if grp == other and a <= b and len(left | right) > 1:
                    members = met[grp, a, b]
                    assert len(members) == sum(x == (grp, z) for x in [(g, k) for (g, _), (_, k) in blocks.items()] for z in {a, b})
        made[size] = len(tiles)
        assert max(len(x) for x in met.values()) < 3 * paths.BLOCK
    assert made[4000] < 2.5 * made[2000]
    assert strays > paths.BLOCK or made[4000] < 2.5 * 4000


def test_nodes_of_many_sets_are_those_of_each():
    source = np.random.default_rng(6)
    sketches = source.integers(0, 1 << 32, (20, paths.TOKENS), dtype=np.uint64).astype("<u4")
    column = pa.array([paths.packed(x) for x in sketches])
    assert np.array_equal(paths.unpacked(column), sketches)
    assert column[3].as_py()[: paths.TOKENS] == sketches[3].astype(np.uint8).tobytes()
    owner, nodes = paths.first_nodes(sketches, range(4, 9))
    for i, own in enumerate(sketches):
        want = paths.mixed(np.arange(5, 10, dtype=np.uint64))
        for _ in range(paths.START):
            want = paths.split(want, np.broadcast_to(own, (len(want), paths.TOKENS)))[1]
        assert sorted(nodes[owner == i].tolist()) == sorted(want.tolist())


def test_exact_links_of_two_blocks():
    """Common tokens by products of matrices or one pair at a time, the same."""
    source = np.random.default_rng(7)
    base = source.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.where(source.random(300) < 0.06, source.integers(0, 1 << 63, 300, dtype=np.uint64), base)) for _ in range(60)]
    near = np.zeros((60, 60), bool)
    near[:25, 25:] = True
    got = paths._exact(near | near.T, sets)
    for a in range(60):
        for b in range(60):
            common = len(np.intersect1d(sets[a], sets[b]))
            like = common >= paths.SIMILARITY * (len(sets[a]) + len(sets[b]) - common) - 1e-9
            assert got[a, b] == (like and (a < 25) != (b < 25))
    assert got.any() and not got[:25, 25:].all()


def test_hashed_words_are_not_kept():
    hashes, words = WordHashes(), [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(0, 100_000, 1000)]
    tracemalloc.start()
    found = [len(shingles(text, hashes)) for text in words]
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert found == [996] * 100 and held < 1 << 20


@pytest.mark.parametrize("edges, rounds", [([(3, 9), (9, 3), (3, 5), (4, 4), (1, 8)], 0), ([(1, 2), (2, 3)], 1)])
def test_components_end_with_stars(spark, monkeypatch, edges, rounds):
    """Edges that are stars already take no round, and the last round is not followed by one that moves nothing."""
    written, settle = [], module.settle
    monkeypatch.setattr(module, "settle", lambda df, label: [written.append(label), settle(df, label)][1])
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({(3, 3), (5, 3), (9, 3), (1, 1), (8, 1)} if not rounds else {(1, 1), (2, 1), (3, 1)})
    assert written.count("stars") == rounds


def test_links_hang_on_the_smallest_set():
    source = np.random.default_rng(9)
    base = source.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.append(base, np.uint64(i))) for i in range(4)] + [np.unique(source.integers(0, 1 << 63, 200, dtype=np.uint64))]
    names = [b"d", b"a", b"c", b"b", b"0"]
    columns = {"sid": names, "brief": [paths.packed(sketch(x))[: paths.TOKENS] for x in sets], "size": [len(x) for x in sets], "texts": [1, 2, 1, 1, 1]}
    columns |= {"block": [0, 1, 1, 1, 1], "low": [0] * 5, "high": [1] * 5, "tokens": [x.tobytes() for x in sets]}
    assert sorted(paths._exact_links(pa.table(columns))) == [(b"a", 1, b"a"), (b"b", 1, b"a"), (b"c", 1, b"a"), (b"d", 4, b"a")]


def test_sets_of_their_own_are_counted_without_their_roots(spark):
    rows = [(node, b"%d" % i, b"%d" % i) for node in range(1, 9) for i in range(node * node)]
    members = spark.createDataFrame(rows, "node long, sid binary, root binary")
    columns = ["node", "sid", "root", "members", "rest"]
    counted = paths._counted(members)
    assert sorted(counted.select(columns).collect()) == sorted(paths._sized(members).select(columns).collect())
    sketched = members.withColumn("sketch", F.lit(bytes(4 * paths.TOKENS)))
    children = paths._children(sketched)
    assert "Exchange" not in children._jdf.queryExecution().executedPlan().toString()
    assert children.count() == children.distinct().count() >= len(rows)
