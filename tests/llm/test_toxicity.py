import random
import zlib
from itertools import product

import numpy as np
import pytest

from hindcast.llm import toxicity
from hindcast.session import shared_folder

LABELS = "doc_id long, toxic int"
BAD = ["blorgle", "snarkish", "vexborn", "vexling", "vextor", "grubble", "muckrat", "foulwig"]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n=900, seed=3, noise=0.0):
    rng = random.Random(seed)
    common = ["".join(rng.choice("aeiounrstl") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(3, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", "."]))
        rows.append((k, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((k, int(toxic) if rng.random() >= noise else 1 - int(toxic)))
    return rows, labels


def auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g, b in product(good, bad)) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(labels, LABELS)
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == 900 and all(found[k].held_out == held(k) for k in found)
    pairs = [(found[r.doc_id], r.toxic) for r in labels.collect() if held(r.doc_id)]
    assert auc([(f.score, y) for f, y in pairs]) > 0.97
    assert np.mean([f.predicted == y for f, y in pairs]) > 0.97
    assert all(f.predicted == (f.score >= 0.5) and 0 <= f.score <= 1 for f in found.values())


def test_held_out_labels_teach_nothing(spark, fitted):
    docs, labels, model = fitted
    turned = [(r.doc_id, 1 - r.toxic if held(r.doc_id) else r.toxic) for r in labels.collect()]
    other = toxicity.fit(docs, spark.createDataFrame(turned, LABELS))
    assert other.terms == model.terms and np.allclose(other.weights, model.weights)


def test_scores_by_hand(fitted):
    docs, _, model = fitted
    for r in toxicity.score(docs, model).limit(40).join(docs, "doc_id").collect():
        terms = toxicity._terms(r.text.encode())
        z = model.constant + sum(w for t, w in zip(model.terms.terms, model.weights) if t in terms)
        z += sum(w for p, w in zip(toxicity.PATTERNS, model.weights[-3:]) if p.search(r.text.encode()))
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)))


def test_voters_are_told_by_accuracy(fitted):
    model = fitted[2]
    lexicons = [a for a, _ in model.voters[: toxicity.WORD_LEXICONS] if a > 0]
    assert len(model.voters) == toxicity.VOTERS and max(lexicons) > 0.8


def test_label_model_finds_accuracies_and_pairs():
    """Votes drawn from a known model, no labels but a few: rates and the dependent pair come back."""
    rng = np.random.default_rng(5)
    n, m = 40_000, 5
    y = rng.random(n) < 0.25
    rates = np.array([[0.05, 0.9], [0.1, 0.8], [0.1, 0.7], [0.02, 0.6], [0.2, 0.2]])
    votes = (rng.random((n, m)) < np.where(y[:, None], rates[:, 1], rates[:, 0])).astype(int)
    copies = rng.random(n) < 0.8
    votes[:, 3] = np.where(copies, votes[:, 2], votes[:, 3])
    patterns = votes @ (1 << np.arange(m))
    kinds, times = np.unique(patterns, return_counts=True)
    known = np.zeros((len(kinds), 2))
    for k in range(200):
        known[np.searchsorted(kinds, patterns[k]), int(y[k])] += 1
    model = toxicity.LabelModel(m).fit(kinds, times.astype(float), known, y[:200].mean())
    assert model.prior == pytest.approx(0.25, abs=0.03)
    assert model.parents[3] == 2 or model.parents[2] == 3
    p = model.posterior(votes)
    true = toxicity.LabelModel(m)
    true.prior, true.parents = 0.25, [-1, -1, -1, 2, -1]
    true.fires = np.repeat(rates[:, :, None], 2, axis=2)
    true.fires[3] = np.array([[0.2 * 0.02, 0.8 + 0.2 * 0.02], [0.2 * 0.6, 0.8 + 0.2 * 0.6]])
    best = np.mean((true.posterior(votes) > 0.5) == y)
    assert np.mean((p > 0.5) == y) > best - 0.01
    accuracy = model.accuracies((kinds[:, None] >> np.arange(m)) & 1, times)
    assert accuracy[0] == pytest.approx(np.mean(votes[:, 0] == y), abs=0.03)


def test_likelihood_never_falls():
    rng = np.random.default_rng(1)
    kinds = np.arange(16)
    times = rng.integers(1, 200, 16).astype(float)
    known = rng.integers(0, 5, (16, 2)).astype(float)
    votes = (kinds[:, None] >> np.arange(4)) & 1
    model = toxicity.LabelModel(4)

    def likelihood():
        total = np.zeros((16, 2))
        for k in (0, 1):
            total[:, k] = [1 - model.prior, model.prior][k]
            for v in range(4):
                rate = model.fires[v, k, 0]
                total[:, k] *= np.where(votes[:, v], rate, 1 - rate)
        return times @ np.log(total.sum(axis=1))

    seen = []
    for rounds in (1, 5, 30):
        model = toxicity.LabelModel(4)
        model._estimate(votes, known)
        for _ in range(rounds):
            counts = model._counts(votes, times, np.zeros((16, 2)))
            model.prior = counts[:, 1].sum() / counts.sum()
            model._estimate(votes, counts)
        seen.append(likelihood())
    assert seen[0] <= seen[1] + 0.5 and seen[1] <= seen[2] + 0.5  # but for the smoothing


def test_regression_against_plain_newton():
    rng = np.random.default_rng(2)
    x = (rng.random((200, 6)) < 0.3).astype(float)
    y, weight = rng.random(200), rng.integers(1, 5, 200).astype(float)
    got, constant = toxicity._regression([np.flatnonzero(r).tolist() for r in x], y, weight, 6, 0.0, ridge=0.5)
    a = np.column_stack([x, np.ones(200)])
    w, ridge = np.zeros(7), np.array([0.5] * 6 + [0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w += np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (weight * (y - p)) - ridge * w)
    assert np.allclose([*got, constant], w, atol=1e-3)


def test_odd_rows(spark, fitted):
    model = fitted[2]
    rows = [(None, None), (1, ""), (2, "blorgle " * 50_000), (3, None), (3, "fine"), (3, "fine"), (4, "xy" * 150_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "'a' AS features")
    found = toxicity.score(docs, model).collect()
    assert len(found) == 7 and {r.predicted for r in found if r.doc_id == 2} == {1}
    plain = {r.score for r in found if r.doc_id != 2}
    assert len(plain) == 1 and plain.pop() < 0.5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_without_documents_or_classes(spark, documents):
    empty = toxicity.fit(documents([]), spark.createDataFrame([], LABELS))
    assert [r.score for r in toxicity.score(documents([(1, "a")]), empty).collect()] == [pytest.approx(0.5)]
    one = spark.createDataFrame([(k, 0) for k in range(50)] + [(None, 1), (3, None), (4, 1)], LABELS)
    clean = toxicity.fit(documents([(k, "a b c") for k in range(50)]), one)
    assert all(r.score < 0.1 for r in toxicity.score(documents([(1, "a")]), clean).collect())


def test_copies_of_a_text_count_once(spark, documents):
    """A text copied often under one label does not make its words signs of that label."""
    rows, labels = corpus(400)
    copied = " ".join(f"peculiar{k}" for k in range(40))
    rows += [(k, copied + f" {k}") for k in range(1000, 1200)]
    labels += [(k, 1) for k in range(1000, 1200)]
    model = toxicity.fit(documents(rows), spark.createDataFrame(labels, LABELS))
    assert not any(t.startswith(b"peculiar") for t in model.terms.terms)


def test_scratch_is_removed(spark, fitted):
    base = shared_folder(spark, "x").rpartition("/")[0]
    import os

    assert not [f for f in os.listdir(base) if f.startswith("hindcast-toxicity")]
