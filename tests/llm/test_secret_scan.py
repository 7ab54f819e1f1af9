"""Base findings against plain code; the network against numeric gradients and on findings it has not seen."""

import copy
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftlode.llm import secret_scan as s

SCHEMA = "doc_id long, text string, findings string"  # a column that clashes with the result


def plain_base(text):
    """The patterns as they are given, one by one from every place."""
    patterns = [
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "AKIA[A-Z0-9]+",
        "[0-9a-f]+",
    ]
    found = []
    for kind, pattern in enumerate(patterns):
        at = 0
        while at < len(text):
            m = re.compile(pattern).match(text, at)
            if m and (len(m.group(2)) >= 6 if kind == 0 else len(m.group()) >= (20 if kind == 1 else 24)):
                found.append((m.start(), kind, m.end()))
            at = m.end() if m else at + 1
    return sorted(found)


PIECES = st.sampled_from(
    ["token", "Secret", "api_Key", "APIKEY", "passwd", "password", ":", "=", " ", '"', "'", "AKIA", "ABCD0123", "abcdef0123", "x", "é", "ſecret", "\n", "-", "."]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=16).map("".join))
def test_base(text):
    assert s.base_findings(text) == plain_base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES | st.sampled_from(["12345678", "longwordwithoutanynumber"]), max_size=12).map("".join))
def test_candidates(text):
    base = s.base_findings(text)
    runs = [m.span() for m in re.finditer("[A-Za-z0-9+/_=-]+", text)]
    want = [(a, b) for a, b in runs if b - a >= 20 or (b - a >= 8 and re.search("[0-9]", text[a:b]))]
    assert list(s.candidates(text, base)) == [(a, b, any(x < b and y > a for x, _, y in base)) for a, b in want]


def test_windows_cover_long_values():
    value = "".join(chr(48 + i % 10) for i in range(1000))
    ids = s.window_ids("before ", value, " after")
    assert ids.shape[1] == s.WINDOW and s.window_ids("", "x", "").shape == (1, s.WINDOW)
    half = s.WINDOW // 2
    whole = np.concatenate([ids[:-1, :half].ravel(), ids[-1]])
    whole = whole[whole != s.PAD]
    assert len(whole) == 1013 and (whole[7:1007] >= s.LETTERS).all() and (whole[:7] < s.LETTERS).all()


def test_gradient():
    source = np.random.default_rng(1)
    network = s.Network()
    network.parts = [part.astype(np.float64) + source.normal(0, 0.2, part.shape) for part in network.parts]
    ids = np.concatenate([s.window_ids(f"a{i} = ", f"value{i}" * (i + 1), "; b") for i in range(6)])
    label = (np.arange(len(ids)) % 2).astype(float)

    def loss():
        score = network._forward(ids)[-1]
        return np.mean(np.log1p(np.exp(score)) - label * score)

    for part, slope in zip(network.parts, network.gradient(ids, label)):
        place = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old = part[place]
        part[place] = old + 1e-5
        high = loss()
        part[place] = old - 1e-5
        low = loss()
        part[place] = old
        assert abs((high - low) / 2e-5 - slope[place]) < 1e-4 * max(1, abs(slope[place]))


def key_text(source, i, name):
    value = "".join(source.choice(list("0123456789abcdef"), 40))
    return f"some words before it {i} {name} = \"{value}\" and after. The number {source.integers(10**11, 10**12)} is no key, nor averyveryverylongword{i}."


def test_network_finds_keys_of_other_names(spark):
    source = np.random.default_rng(2)
    seen = spark.createDataFrame([(i, key_text(source, i, "token"), "") for i in range(300)], SCHEMA)
    detector = s.fit(seen)
    assert detector.threshold >= s.LOWEST
    # Upper case keys under another name match no pattern; numbers and long words are to be left alone.
    other = [(i, key_text(source, i, "signing").replace("token", "x"), "") for i in range(100)]
    upper = [(i, re.sub('"(.*)"', lambda m: '"' + m.group(1)[:20] + '"', text), "") for i, text, _ in other]
    rows = s.scan(spark.createDataFrame(upper, SCHEMA), detector).collect()
    added = [[f for f in row.findings if f.kind == "network"] for row in rows]
    texts = {i: text for i, text, _ in upper}
    keys = sum(any(re.fullmatch("[0-9a-f]{20}", texts[row.doc_id][f.first : f.stop]) for f in fs) for row, fs in zip(rows, added))
    wrong = sum(not re.fullmatch("[0-9a-f]{20}", texts[row.doc_id][f.first : f.stop]) for row, fs in zip(rows, added) for f in fs)
    assert keys >= 60 and wrong <= 5


def test_held_out_documents(spark, folder):
    """Fit on even ids; candidates of odd ones, judged without their labels."""
    docs = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.1"))
    detector = s.fit(docs.filter("doc_id % 2 = 0"))
    rows = s.labelled_findings(docs.filter("doc_id % 2 = 1")).collect()
    chance = detector.probability([(r.before, r.value, r.after) for r in rows])
    known = np.array([r.known for r in rows]) == 1
    found = chance >= detector.threshold
    assert found[known].mean() >= 0.95 and found[~known].mean() <= 0.05


def test_scan_and_digest(spark):
    texts = [
        None, "", "no secret here", "ü token: abcdef0123456789abcdef01 x", "é" * 50_000 + ' password = "hunter22" ', "AKIA" + "A1" * 9,
        "token: token: abcdefgh", "0" * 200_000, "api_key='x' 5",
    ]
    rows = [(i, text, "") for i, text in enumerate(texts)] + [(3, texts[3], "")] * 3 + [(None, texts[5], "")]
    found = s.digest(s.scan(spark.createDataFrame(rows, SCHEMA).repartition(3), None))
    assert found.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for key, text, _ in rows:
        base = plain_base(text or "") if len(text or "") < 60_000 else [(0, 2, 200_000)]
        joined = ",".join(f"{s.KINDS[kind]}:{start}:{end}" for start, kind, end in base)
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        want.append((key, *counts, hashlib.sha256(joined.encode()).hexdigest(), joined, 0))
    order = lambda row: (row[0] is None, row[0] or 0)
    assert sorted((tuple(row) for row in found.collect()), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("texts", [[], [None], ["token = abcdefgh12"]])
def test_nothing_to_learn_from(spark, texts):
    docs = spark.createDataFrame([(i, text, "") for i, text in enumerate(texts)], SCHEMA)
    assert s.fit(docs) is None
    assert s.scan(docs, None).count() == len(texts)


def test_all_findings_count(spark, monkeypatch):
    """Every finding of every document is trained on or held out, in several shards as in one; reruns agree."""
    source = np.random.default_rng(4)
    rows = [(i, key_text(source, i, "token"), "") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    parts, plain = [], s.held_scores
    monkeypatch.setattr(s, "held_scores", lambda found, *rest: parts.append(found) or plain(found, *rest))
    detector = s.fit(docs)
    found = parts[0].selectExpr("sum(known)", "count(*)", "count(DISTINCT shard)").first()
    assert found[0] == 3000 and found[1] == 9000 and found[2] == -(-9000 // s.SHARD)
    again = s.fit(docs.repartition(7))
    assert (again.slope, again.offset, again.threshold) == (detector.slope, detector.offset, detector.threshold)
    some = parts[0].filter("held = 1").limit(2000).collect()
    chance = detector.probability([(r.before, r.value, r.after) for r in some]) >= detector.threshold
    known = np.array([r.known for r in some]) == 1
    assert chance[known].mean() >= 0.95 and chance[~known].mean() <= 0.02


def kept(monkeypatch, name):
    """The first arguments of the calls of a function of the module, which goes on as before."""
    calls, plain = [], getattr(s, name)
    monkeypatch.setattr(s, name, lambda first, *rest: calls.append(first) or plain(first, *rest))
    return calls


def test_all_epochs_read_all_shards(spark, monkeypatch):
    """With several shards the network is the mean of theirs after each of all the epochs, as trained here one by one."""
    source = np.random.default_rng(5)
    rows = [(i, key_text(source, i, "token"), "") for i in range(150)]
    monkeypatch.setattr(s, "SHARD", 128)
    calls = kept(monkeypatch, "held_scores")
    detector = s.fit(spark.createDataFrame(rows, SCHEMA).repartition(3))
    shards = {}
    for row in calls[0].collect():
        shards.setdefault(row.shard, []).append((row.value, row.before, row.after, row.known, row.held))
    assert len(shards) == 4 and sum(map(len, shards.values())) == 450
    network = s.Network()
    for epoch in range(12):
        each = []
        for shard in shards.values():
            items, label, held = s._items(shard, [])
            own = copy.deepcopy(network)
            ids = [s.window_ids(*item) for item, out in zip(items, held) if not out]
            own.train(ids, label[~held], np.where(label[~held], 1.0, 0.5), 1, s.SEED + epoch)
            each.append(own.parts)
        network.parts = [np.mean(same, axis=0).astype(np.float32) for same in zip(*each)]
    assert all(np.allclose(a, b, rtol=0, atol=1e-3) for a, b in zip(network.parts, detector.network.parts))


def test_long_values_are_learned_whole(spark):
    """Values that are equal up to the end of the first window are told apart by what follows."""
    source = np.random.default_rng(6)
    start = "".join(source.choice(list("ghijklmnop"), 170))

    def text(i):
        key, word = ("".join(source.choice(list(letters), 40)) for letters in ("0123456789abcdef", "qrstuvwxyz"))
        return f"the one is {start}{key} , the other {start}{word} and so on"

    seen, new = (spark.createDataFrame([(i, text(i), "") for i in range(count)], SCHEMA) for count in (300, 100))
    assert s.labelled_findings(seen).groupBy("known").count().orderBy("known").collect() == [(0, 300), (1, 300)]
    detector = s.fit(seen)
    rows = s.labelled_findings(new).collect()
    chance = detector.probability([(r.before, r.value, r.after) for r in rows]) >= detector.threshold
    # The highest window is the one that learns, whichever it is.
    known = np.array([r.known for r in rows]) == 1
    assert chance[known].mean() >= 0.9 and chance[~known].mean() <= 0.05


def test_window_that_learns():
    """A step of training on a long value is one on its highest window."""
    windows = s.window_ids("", "".join(chr(48 + i % 10) if i > 200 else "x" for i in range(400)), "")
    whole, single = s.Network(), s.Network()
    best = int(whole.score(windows).argmax())
    whole.train([windows], np.array([1]), np.array([1.0]), 1)
    single.train([windows[best : best + 1]], np.array([1]), np.array([1.0]), 1)
    assert len(windows) > 2 and all((a == b).all() for a, b in zip(whole.parts, single.parts))


def test_shards_by_windows(spark, monkeypatch):
    """Long values make shards of fewer findings, and all of them are read in all epochs."""
    source = np.random.default_rng(8)
    texts = [f"{i} {'z' * 5000}{''.join(source.choice(list('0123456789abcdef'), 40))} or {'y' * 5000}{i}" for i in range(40)]
    monkeypatch.setattr(s, "WINDOWS", 80 * 8)
    calls, means = kept(monkeypatch, "held_scores"), kept(monkeypatch, "trained")
    s.fit(spark.createDataFrame([(i, text, "") for i, text in enumerate(texts)], SCHEMA))
    assert calls[0].count() == 80 and calls[0].agg({"shard": "max"}).first()[0] < 10
    assert calls[0].select("shard").distinct().count() > 5 and len(means) == s.EPOCHS


def test_secrets_of_all_shards_in_foreign_context(spark, monkeypatch):
    """Shards without an ordinary candidate show their secrets in the contexts of other shards' ordinary ones."""
    items, label, held = s._items([("w", "b", "a", 1, 1), ("v", "b", "a", 1, 0)], [("x", "y")])
    assert items == [("b", "v", "a"), ("b", "w", "a"), ("x", "v", "y"), ("x", "w", "y")]
    assert label.tolist() == [1] * 4 and held.tolist() == [False, True] * 2
    source = np.random.default_rng(9)
    texts = [f"token = {''.join(source.choice(list('0123456789abcdef'), 30))} ;" for _ in range(200)]
    texts += [f"the number {10**11 + 7 * i} ;" for i in range(8)]
    monkeypatch.setattr(s, "SHARD", 16)
    found, scores = kept(monkeypatch, "held_scores"), kept(monkeypatch, "logistic_fit")
    s.fit(spark.createDataFrame([(i, text, "") for i, text in enumerate(texts)], SCHEMA))
    bare = found[0].groupBy("shard").agg({"known": "min"}).filter("`min(known)` = 1").count()
    out = {row.known: row["count"] for row in found[0].filter("held = 1").groupBy("known").count().collect()}
    shown = {row.label: row["count"] for row in scores[0].groupBy("label").count().collect()}
    assert bare > 0 and shown == {1: 2 * out[1], 0: out[0]}


def test_shard_without_training_rows(spark):
    """A shard in which all is held out does not count in the mean of the networks."""
    rows = [(i % 2, f"value{i:04}", "is ", " here", i // 2 % 2, int(i % 2 == 0)) for i in range(60)]
    found = spark.createDataFrame(rows, "shard long, value string, before string, after string, known long, held long")
    both, one = (s.trained(s.packed(part, 2), [], s.Network(), np.ones(2), 1, 3) for part in (found, found.filter("shard = 1")))
    assert all((a == b).all() for a, b in zip(both.parts, one.parts)) and (both.parts[4] != s.Network().parts[4]).any()
