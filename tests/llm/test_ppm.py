import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from hindcast.llm import ppm
from tests.llm.brute import LOWER, words


def side(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def brute_model(learnt, order, support):
    """Counts of symbols after every context held, found by plain search."""
    streams = [[*t.encode(), 256] for t in learnt]
    least = max(support * sum(map(len, streams)), 1)
    counts = {(): Counter(s for x in streams for s in x)}
    for depth in range(1, order + 1):
        found = {}
        for x in streams:
            for i in range(depth, len(x)):
                found.setdefault(tuple(x[i - depth : i]), Counter())[x[i]] += 1
        counts |= {
            c: n for c, n in found.items() if c[:-1] in counts and counts[c[:-1]][c[-1]] >= least
        }
    return counts


def brute_score(counts, order, text):
    total, stream = 0.0, [*text.encode(), 256]
    for i, s in enumerate(stream):
        context = tuple(stream[max(0, i - order) : i])
        while context not in counts:
            context = context[1:]
        excluded, chance = set(), 1.0
        while True:
            seen = {k: n for k, n in counts[context].items() if k not in excluded}
            whole = sum(seen.values()) + len(seen)
            if s in seen:
                chance *= seen[s] / whole
                break
            if seen:
                chance *= len(seen) / whole
            excluded |= set(seen)
            if not context:
                chance /= 257 - len(excluded)
                break
            context = context[1:]
        total += math.log10(chance)
    return total


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    parts = ["the", "and", "tion", "ing", "Er", "é", "al", "re", "st"]
    text = lambda: " ".join(
        "".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.choice([0, 1, 9, 200]))
    )
    return [(i, text()) for i in range(n)]


@pytest.mark.parametrize("order, support", [(4, 2**-9), (2, 0.0), (0, 0.1)])
def test_same_as_brute_force(documents, order, support):
    rows = [*corpus(), (200, "Zx \x01 unseen ß"), (None, "the"), (201, None), (202, " ")]
    rows += [rows[2], rows[2]]
    lowered = [(i, (t or "").translate(LOWER)) for i, t in rows]
    learnt = [t for i, t in lowered if side(i) != 1]
    model = brute_model(learnt, order, support)
    count = Counter(w for t in learnt for w in [*words(t), ""])
    n, v = sum(count.values()), len(count)
    want = sorted(
        (
            str(i), side(i) == 1, len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), ""]), n,
            round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(t), ""]), 6),
            round(brute_score(model, order, t), 2),
        )
        for i, t in lowered
    )
    got = sorted(
        (str(r.doc_id), *r[1:5], round(r.base_score, 6), round(r.score, 2))
        for r in ppm.score(documents(rows), order=order, support=support).collect()
    )
    for g, w in zip(got, want, strict=True):
        assert g[:6] == w[:6]
        assert g[6] == pytest.approx(w[6], rel=1e-4, abs=0.02)


def test_probabilities_add_up(documents):
    model = ppm.train(documents(corpus()), order=3, support=2**-10)
    chance = 10.0 ** model.score.reshape(-1, model.width).astype(float)
    unseen = 257 - (model.width - 2)
    assert len(model.contexts) > 100
    np.testing.assert_allclose(chance[:, 2:].sum(axis=1) + unseen * chance[:, 1], 1, rtol=1e-5)


def test_texts_like_the_training_text_are_likelier(documents):
    rows = [r for r in corpus(200, 3) if len(r[1]) > 200]
    rng = random.Random(5)
    jumbled = [(1000 + i, "".join(rng.sample(t, len(t)))) for i, t in rows if side(i) == 1]
    found = {r.doc_id: r.score for r in ppm.score(documents(rows), support=2**-9).collect()}
    model = ppm.train(documents([r for r in rows if side(r[0]) != 1]), support=2**-9)
    worse = model.scores([t.translate(LOWER).encode() for _, t in jumbled])
    for (i, _), w in zip(jumbled, worse, strict=True):
        assert found[i - 1000] > 0.8 * w > w


def test_very_long_text_and_nothing_to_learn(documents):
    long = "the thing " * 120_000
    learnt_from = next(i for i in range(99) if side(i) != 1)
    found = ppm.score(documents([(learnt_from, long)])).collect()[0]
    assert found.n_tokens == found.n_known == found.train_tokens == 240_001
    left_out = next(i for i in range(99) if side(i) == 1)
    docs = documents([(left_out, "ab")]).selectExpr("*", "1 AS score", "2 AS learn", "3 AS row")
    alone = ppm.score(docs).collect()[0]
    assert alone.score == pytest.approx(3 * math.log10(1 / 257), rel=1e-5)
    assert (alone.n_known, alone.train_tokens) == (0, 0)
    assert ppm.score(documents([])).collect() == []


def test_rare_contexts_are_held_whatever_the_size_of_the_corpus(documents):
    rows = corpus(400, 7)
    learnt_from = [i for i in range(1000, 1020) if side(i) != 1][:2]
    rare = "quixotic zephyrs jinxed my vow"
    rows += [(i, rare) for i in learnt_from]
    rows.append((next(i for i in range(2000, 2020) if side(i) == 1), rare + "s"))
    lowered = {i: t.translate(LOWER) for i, t in rows}
    learnt = [t for i, t in lowered.items() if side(i) != 1]
    assert sum(len(t) + 1 for t in learnt) > 3 * 2**14
    model = brute_model(learnt, 4, 0.0)
    found = {r.doc_id: r.score for r in ppm.score(documents(rows)).collect()}
    for i, _ in rows[-20:]:
        assert found[i] == pytest.approx(brute_score(model, 4, lowered[i]), rel=1e-6)
    with pytest.raises(ValueError):
        ppm.score(documents(rows), order=7)


def test_groups_cut_anywhere(monkeypatch):
    texts = [t.encode() for _, t in corpus(30, 2)] + [b"", b"ab"]
    whole = [(o, k) for owner, key in ppm._keyed(texts, 4) for o, k in zip(owner, key, strict=True)]
    monkeypatch.setattr(ppm, "PIECE", 7)
    cut = [(o, k) for owner, key in ppm._keyed(texts, 4) for o, k in zip(owner, key, strict=True)]
    assert cut == whole and len(whole) == sum(len(t) + 1 for t in texts)
