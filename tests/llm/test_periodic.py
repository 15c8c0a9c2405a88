import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hindcast.llm import periodic
from hindcast.llm.queries import op13_rows
from tests.llm.brute import words


def brute_runs(w, least=12):
    found = {}
    for q in range(len(w) // 2, 0, -1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found[i, j + q] = q  # smaller periods come last
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_planted(doc_id, w):
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def brute(doc_id, text):
    w = brute_planted(doc_id, words(text))
    rows = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in rows for k in range(s + q, s + n)}
    best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(rows),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{n},{q}\n" for s, n, q in rows)),
        sha(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def text(rng):
    """Random words, stretches repeated, nested and cut off."""
    w = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice("abc") if rng.random() < 0.7 else rng.choice(["dé", "e,", "F"]) for _ in range(rng.randint(1, 9))]
        times = rng.choice([1, 1, 2, 3, 9])
        part = unit * times
        w += part[: len(part) - rng.randint(0, min(3, len(part) - 1))]
    return rng.choice([" ", "  ", "\n"]).join(w)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5))
def test_runs_as_by_hand(documents):
    got = periodic.found_in(documents, 12)
    assert [[tuple(r) for r in rows.tolist()] for rows in got] == [brute_runs(d) for d in documents]


def test_fibonacci_words_and_one_word():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 700:
        a, b = b, b + a
    for w in (b, [b"x"] * 500, [b"x"] * 12, [b"x"] * 11):
        assert [tuple(r) for r in periodic.found_in([w], 12)[0].tolist()] == brute_runs(w)


def test_children_in_small_portions(monkeypatch):
    monkeypatch.setattr(periodic, "TOGETHER", 5)
    w = [bytes([c]) for c in b"abcabcabcabcxabcabcabcabcabcy" * 4]
    assert [tuple(r) for r in periodic.found_in([w, w], 12)[1].tolist()] == brute_runs(w)


def test_query_as_by_hand(documents):
    rng = random.Random(13)
    rows = [(k, text(rng)) for k in range(400)]
    rows += [(1, None), (2, ""), (3, " \n"), (None, "a b " * 30), (None, None), (7, rows[7][1]), (9, "x " * 3000)]
    rows += [(10**12, "  " * 40), (-5, "a b c d " * 9)]
    got = op13_rows(documents(rows))
    assert got.columns[:8] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert sorted([tuple(r[:8]) for r in got.collect()], key=str) == sorted([brute(*r) for r in rows], key=str)


def test_texts_and_spans_of_the_operator(documents):
    (row,) = periodic.collapsed(documents([(4, "so " + "na na hey " * 5 + "good bye")])).collect()
    assert row.text == "so na na hey good bye"
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)]


def test_empty_table_clashing_columns_and_short_runs(spark, documents):
    assert op13_rows(documents([])).count() == 0
    odd = spark.createDataFrame([("a " * 20, 1, "r", "w")], "text string, n long, runs string, period string")
    (row,) = op13_rows(odd).collect()
    assert row.doc_id is None and row.n_runs == 1 and row.period == 1
    with pytest.raises(ValueError):
        periodic.collapsed(odd, least=6)


def test_ranks_agree_with_comparison():
    codes = np.array([0, 1, 0, 1, 0, 0, 1, 0, 1, 1])
    ranks = periodic._Ranks(codes)
    for i in range(10):
        for j in range(10):
            if i != j:
                k = 0
                while max(i, j) + k < 10 and codes[i + k] == codes[j + k]:
                    k += 1
                b = 0
                while min(i, j) - b > 0 and codes[i - b - 1] == codes[j - b - 1]:
                    b += 1
                assert ranks.ahead(np.array([i]), np.array([j]))[0] == k
                assert ranks.behind(np.array([i]), np.array([j]))[0] == b
