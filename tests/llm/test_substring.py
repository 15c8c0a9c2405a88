import hashlib
import random

import pytest

from hindcast.llm import substring
from tests.llm.brute import words


def brute(rows, window):
    """Rows of different ids, or of the same id and text."""
    split = {(i, t): words(t) for i, t in rows}
    seen, cut = {}, {}
    for key in sorted(split, key=lambda k: (k[0] is None, k[0] or 0)):
        w = split[key]
        gone = set()
        for p in range(len(w) - window + 1):
            part = tuple(w[p : p + window])
            if part in seen:
                gone.update(range(p, p + window))
            seen.setdefault(part, (key, p))
        cut[key] = [x for p, x in enumerate(w) if p not in gone]
    return sorted(
        (
            (i, len(split[i, t]), len(split[i, t]) - len(cut[i, t]),
             hashlib.sha256(" ".join(cut[i, t]).encode()).hexdigest())
            for i, t in rows
        ),
        key=str,
    )


def got(docs, window, **how):
    found = substring.removals(docs, window=window, **how)
    found = found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted((tuple(r) for r in found), key=str)


@pytest.mark.parametrize("window, shortest", [(20, 10), (20, 3), (7, 10)])
def test_same_as_brute_force(documents, window, shortest):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [rng.choices(vocabulary, k=rng.randrange(5, 60)) for _ in range(12)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randrange(0, 6)):
            few = rng.random() < 0.3
            text += rng.choice(passages) if rng.random() < 0.5 else rng.choices(
                vocabulary[:3] if few else vocabulary, k=rng.randrange(40)
            )
        if i % 9 == 0 and rows:
            text = words(rows[rng.randrange(len(rows))][1])
        rows.append((i * 7 % 80, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [rows[5], rows[5]]
    found = got(documents(rows), window, shortest=shortest)
    assert found == brute(rows, window)
    assert sum(r[2] for r in found) > 300


def test_odd_rows(documents):
    common = " ".join(f"c{i}" for i in range(30))
    long = " ".join(f"x{i % 700}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (None, common), (9, "a " + common), (4, long), (5, "é " + common)]
    assert got(documents(rows), 20) == brute(rows, 20)


def test_documents_without_what_repeats(spark, documents):
    assert got(documents([]), 20) == []
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(1, common), (2, "one\ntwo " + common), (3, common), (4, "short"), (5, None)]
    docs = documents(rows).selectExpr("*", "1 AS mark", "2 AS left", "3 AS id", "'t' AS doc")
    left = substring.without_repeats(docs, window=20)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in left.collect()) == [
        (1, common, len(common)),
        (2, "one two", 7),
        (4, "short", 5),
        (5, None, 0),
    ]


def test_short_windows_are_refused(documents):
    with pytest.raises(ValueError):
        substring.removals(documents([(1, "a")]), window=1)
