"""The network against its gradient, scores against plain sums, and learning on text it has not seen."""

import numpy as np
import pyarrow as pa
import pytest

from shiftlode.llm import masked
from shiftlode.llm.common import WordHashes, words_of
from shiftlode.llm.masked import Network, Vocabulary, buckets_of, pseudo_likelihood, score, score_texts, train_task, windows

SENTENCES = ["the cat sat on the mat", "le chat est sur le tapis", "ein hund lief durch den wald"]


def corpus(n, seed):
    source = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = SENTENCES[source.integers(0, 3)].split()
        out.append(" ".join(words[i] for i in source.integers(0, len(words), int(source.integers(20, 200)))))
    return out


def arrays(texts):
    return [buckets_of(text, WordHashes()) for text in texts]


def vocabulary(texts):
    return Vocabulary(sum(np.bincount(x, minlength=masked.BUCKETS) for x in texts).astype(float))


def test_probabilities_sum_to_one():
    own = vocabulary(arrays(corpus(20, 1)))
    network = Network(own)
    window = np.array([[0, 5, 6, 7]])
    kinds = np.arange(len(own.log_class))
    assert np.isclose(np.exp(network.log_probability(np.repeat(window, len(kinds), axis=0), kinds)).sum(), 1, atol=1e-5)
    assert np.isclose(sum(np.exp(own.log_share[own.kind == k]).sum() for k in kinds), len(kinds))


def test_windows_see_both_sides():
    buckets = np.arange(10, 10 + 2 * masked.PIECE + 3)
    window, target = (np.concatenate(x) for x in zip(*windows(buckets)))
    assert np.array_equal(target, buckets)
    row = 1 + buckets % (masked.FEATURES - 1)
    assert window[0].tolist() == [0, 0, row[1], row[2]] and window[-1].tolist() == [row[-3], row[-2], 0, 0]
    at = masked.PIECE
    assert window[at].tolist() == [row[at - 2], row[at - 1], row[at + 1], row[at + 2]]


def test_learning_lowers_the_loss_on_new_texts():
    seen, new = arrays(corpus(300, 1)), arrays(corpus(50, 2))
    own = vocabulary(seen)
    network = Network(own)
    mean = lambda: sum(s for _, s in score_texts(new, network, own)) / sum(n for n, _ in score_texts(new, network, own))
    before = mean()
    for offset in range(masked.STRIDE):
        train_task(seen, network, own, offset)
    assert mean() < 0 and mean() > before + 0.3


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, text, "x") for i, text in enumerate(corpus(200, 3))]
    rows += [(900, None, None), (901, "", "x"), (None, rows[0][1], "x"), (0, rows[0][1], "x"), (902, "mixed " * 200_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    return rows, df, pseudo_likelihood(df).collect()


def test_rows(scored):
    rows, _, got = scored
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"]) for r in got) == sorted((i is None, i, len(words_of(t))) for i, t, _ in rows)
    same = [r["log_likelihood"] for r in got if r["doc_id"] in (None, 0)]
    assert len(same) == 3 and np.allclose(same, same[0], rtol=1e-6)
    for row in got:
        assert row["mean_log_likelihood"] == (row["log_likelihood"] / row["n_tokens"] if row["n_tokens"] else None)
        assert row["n_tokens"] or row["log_likelihood"] == 0


def test_scores_are_sums_over_tokens(spark):
    texts = corpus(30, 5) + ["a b " * 80_000]
    own = vocabulary(arrays(texts))
    network = Network(own)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in score(masked.encoded(df, "doc_id", "text"), network, own).collect():
        logs = [network.log_probability(w, own.kind[t]).astype(float) + own.log_share[t] for w, t in windows(arrays(texts)[row["doc_id"]])]
        assert np.isclose(row["log_likelihood"], np.concatenate(logs).sum(), rtol=1e-5)


def test_documents_in_order_score_better(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.1")).filter("doc_id % 4 = 0")
    texts = arrays([r["text"] for r in documents.filter("doc_id % 16 = 0").collect()])
    own = vocabulary(texts)
    network = masked.train(masked.encoded(documents, "doc_id", "text"), own)
    mean = lambda net: sum(s for _, s in score_texts(texts, net, own)) / sum(n for n, _ in score_texts(texts, net, own))
    assert mean(network) > mean(Network(own)) + 0.03


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pseudo_likelihood(df).count() == 0
    assert [tuple(r) for r in pseudo_likelihood(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [(1, 0, 0.0, None)]


def test_every_token_is_learnt_once(spark):
    texts = ["a", "b c", "d e f", " ".join(f"w{i}" for i in range(5001))]
    tokens = masked.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "doc_id", "text")
    own = vocabulary(arrays(texts))

    class Seen:
        kinds = 0

        def learn(self, window, kind, share=1.0):
            assert len(window) == len(kind)
            self.kinds += len(kind)

    for rounds in (1, masked.ROUNDS, 3):
        seen, total = Seen(), 0
        for offset in range(rounds):
            total += train_task(arrays(texts), seen, own, offset, rounds)
        assert seen.kinds == total == sum(len(x) for x in arrays(texts))
    assert masked.STRIDE == masked.ROUNDS
    only = arrays([texts[2]])
    network = masked.train(tokens.filter("doc_id = 2"), own)
    one = Network(own)
    for offset in range(masked.ROUNDS):
        assert train_task(only, one, own, offset) == (2, 1)[offset]
    assert np.allclose(network.flat, one.flat, atol=1e-5) and not np.allclose(network.flat, Network(own).flat)


def colliding():
    """Two words of one bucket."""
    seen = {}
    for i in range(100_000):
        word = f"w{i}"
        other = seen.setdefault(int(buckets_of(word, WordHashes())[0]), word)
        if other != word:
            return other, word


@pytest.mark.parametrize("most", [masked.FREQUENT, 1, 0])
def test_words_of_one_bucket_are_told_apart(spark, monkeypatch, most):
    often, rare = colliding()
    texts = [f"a {often} b"] * 99 + [f"a {rare} b", f"{rare} {rare} x y", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(masked.frequent_words, "__defaults__", (most,))
    got = {r["doc_id"]: r for r in pseudo_likelihood(df).collect()}
    assert len(got) == len(texts) and got[101]["log_likelihood"] == 0
    assert np.isclose(got[0]["log_likelihood"] - got[99]["log_likelihood"], np.log(99 / 3), atol=1e-5)
    tokens = masked.encoded(df, "doc_id", "text")
    counts = {r["word"]: r["n"] for r in masked.count_words(tokens).collect()}
    assert sorted(counts.values()) == [1, 1, 3, 99, 100, 100]


def test_words_of_one_class_depend_on_the_window():
    source = np.random.default_rng(4)
    texts = [" ".join(f"l{k} m{k} r{k}" for k in source.integers(0, 500, 300)) for _ in range(150)]
    own = vocabulary(arrays(texts))
    one = own.kind[buckets_of("m1", WordHashes())[0]]
    assert len(own.log_group) <= masked.CLASSES < len(own.log_class) <= masked.CLASSES * masked.CELLS
    network = Network(own)
    for _ in range(6):
        for offset in range(masked.STRIDE):
            train_task(arrays(texts), network, own, offset)
    at = {name: 1 + buckets_of(name, WordHashes())[0] % (masked.FEATURES - 1) for name in ("l1", "r1", "l2", "r2")}
    cells = np.arange(*own.first[own.group[one] :][:2])
    assert len(cells) > 1

    def inside(k):
        window = np.repeat([[0, at[f"l{k}"], at[f"r{k}"], 0]], len(cells), axis=0)
        logs = network.log_probability(window, cells)
        return logs - np.log(np.exp(logs).sum())

    assert not np.allclose(inside(1), inside(2), atol=1e-3)
    assert inside(1)[one - cells[0]] > inside(2)[one - cells[0]]


def plain_step(network, window, kind, share):
    """One step of descent, class by class in plain matrix products."""
    hidden = np.tanh(sum(network.tables[i][window[:, i]] for i in range(2 * masked.SIDE)) + network.bias)

    def error_of(logits, chosen):
        found = np.exp(logits - logits.max(axis=1, keepdims=True))
        found /= found.sum(axis=1, keepdims=True)
        found[np.arange(len(chosen)), chosen] -= 1
        return found

    group = network.group[kind]
    error = error_of(hidden @ network.out + network.prior, group)
    back = error @ network.out.T
    for each in np.unique(group):
        cells, own = slice(*network.first[each : each + 2]), group == each
        wrong = error_of(hidden[own] @ network.inner[cells].T + network.inner_prior[cells], kind[own] - cells.start)
        back[own] += wrong @ network.inner[cells]
        pace = share * masked.RATE / max(own.sum(), masked.CELLS)
        network.inner[cells] -= pace * (wrong.T @ hidden[own])
        network.inner_prior[cells] -= pace * wrong.sum(axis=0)
    back *= 1 - hidden**2
    step = share * masked.RATE / len(kind)
    network.out -= step * (hidden.T @ error)
    network.prior -= step * error.sum(axis=0)
    network.bias -= step * back.sum(axis=0)
    for place in range(2 * masked.SIDE):
        for row in np.unique(window[:, place]):
            own = window[:, place] == row
            network.tables[place][row] -= share * masked.TABLE_RATE * back[own].sum(axis=0) / np.sqrt(own.sum())


def test_a_step_takes_all_classes_at_once(monkeypatch):
    source = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in source.zipf(1.3, 3000) % 5000) for _ in range(3)] + ["the " * 400]
    own = vocabulary(arrays(texts))
    sizes = np.bincount(own.group)
    assert sizes.min() == 1 < sizes.max() and len(sizes) > 10  # classes of one cell, and of several
    held = [(w, own.kind[t]) for x in arrays(texts) for w, t in windows(x)]
    calls, plain = [], masked.softmax_error
    monkeypatch.setattr(masked, "softmax_error", lambda *given: calls.append(1) or plain(*given))
    one, other = Network(own), Network(own)
    for share, (window, kind) in zip((1.0, 0.5, 1.0, 1.0), held):
        one.learn(window, kind, share)
        plain_step(other, window, kind, share)
    assert np.allclose(one.flat, other.flat, atol=2e-5) and not np.allclose(one.flat, Network(own).flat, atol=1e-2)
    assert len(calls) == 2 * len(held)  # classes and cells, not one for each class


def test_words_of_many_texts_are_looked_up_at_once(monkeypatch):
    texts = [np.arange(i % 7, dtype="<i8") for i in range(1000)]
    columns = [list(range(1000)), [x.tobytes() for x in texts], [(x + 1).tobytes() for x in texts]]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["row", "words", "times"])
    expected = [(i, w, w + 1) for i, x in enumerate(texts) for w in x.tolist()]
    for most in (masked.HELD, 8):
        monkeypatch.setattr(masked, "HELD", most)
        got = list(masked.gathered([batch]))
        assert len(got) == 1 if most > 8 else len(got) > 100  # bounded by words, however many texts
        assert [tuple(map(int, x)) for part in got for x in zip(*part)] == expected
