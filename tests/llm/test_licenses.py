import random
import re
from collections import Counter

import pytest

from hindcast.llm import licenses
from tests.llm.brute import LOWER

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
    return row[-1]


def notices(w, templates, threshold):
    """(start, end, label, containment, n) of every block's first and shortest best place."""
    seen = set()
    for label, words in templates:
        n = len(words)
        for start in range(0, len(w), n):
            block = w[start : start + 2 * n]
            if sum((Counter(block) & Counter(words)).values()) < threshold * n - 1e-9:
                continue
            best = common(block, words)
            if best < threshold * n - 1e-9:
                continue
            end = next(e for e in range(len(block) + 1) if common(block[:e], words) == best)
            first = next(f for f in range(end, -1, -1) if common(block[f:end], words) == best)
            seen.add((start + first, start + end, label, best / n, n))
    return {
        m for m in seen
        if not any(
            (o[3], o[4]) > (m[3], m[4])
            and 2 * (min(m[1], o[1]) - max(m[0], o[0])) > min(m[1] - m[0], o[1] - o[0])
            for o in seen
        )
    }


def brute(rows, threshold=0.8, texts=licenses.TEMPLATES):
    templates = [(label, SPLIT.findall(t.translate(LOWER))) for t, label in texts.items() if t]
    found = []
    for i, text in rows:
        w = SPLIT.findall((text or "").translate(LOWER))
        places = [
            (p, label)
            for phrase, label in licenses.PHRASES.items()
            for p in range(len(w))
            if w[p : p + len(phrase.split())] == phrase.split()
        ]
        matches = notices(w, templates, threshold)
        base = sorted({label for _, label in places})
        starts = [p for p, _ in places]
        found.append((
            i, len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(base), ",".join(sorted({*base, *(m[2] for m in matches)})),
            1.0 if places else max((m[3] for m in matches), default=0.0),
            sorted({m[:4] for m in matches}),
        ))
    return sorted(found, key=str)


def got(frame):
    rows = [(*r[:-1], [tuple(m) for m in r.matches or []]) for r in frame.collect()]
    return sorted(rows, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    texts = list(licenses.TEMPLATES)
    rows = []
    for i in range(120):
        parts = [f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 5, 100, 400]))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(texts).split()
            for _ in range(rng.randrange(0, 8)):
                notice[rng.randrange(len(notice))] = rng.choice(["x", "the", "License"])
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = notice
        if rng.random() < 0.3:
            parts.append(rng.choice(["MIT License", "mit-license, the APACHE\nlicense", "a mit license mit license"]))
        rows.append((i, rng.choice([" ", "\n", ", "]).join(parts)))
    return rows


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_same_as_brute_force(documents, threshold):
    rows = corpus()
    found = got(licenses.scan(documents(rows), threshold=threshold))
    assert found == brute(rows, threshold)
    assert len({r[6] for r in found}) > 5


def test_repeated_words_count_as_often_as_they_stand(documents):
    texts = {"a b a b a c": "one", "a b c d": "two", "": "none", "a " * 9: "nine"}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.choice([0, 3, 9, 40])))) for i in range(60)]
    found = licenses.scan(documents(rows), templates=texts)
    assert got(found) == brute(rows, texts=texts)


def test_variants_are_told_apart(documents):
    rows = [
        (1, "Licensed under CC BY-SA 4.0"),
        (2, "The version 4 patch, by licensed staff, was merged under review; see cc list 0"),
        (3, "Licensed under CC BY-NC 4.0, all of it"),
        (4, "as said: licensed under CC BY 4.0."),
        (5, "Licensed under CC BY-NC-SA 4.0"),
        (6, "Licensed under CC BY-SA 4.0. " + "x " * 9 + "Licensed under CC BY-NC 4.0"),
        *[(10 + k, f"x y {t} z") for k, t in enumerate(licenses.TEMPLATES)],
    ]
    # fixed phrases, "general public license" among them, have labels of their own
    found = {r[0]: sorted({m[2] for m in r[8]}) for r in got(licenses.scan(documents(rows)))}
    assert [found[i] for i in range(1, 7)] == [
        ["cc-by-sa"], [], ["cc-by-nc"], ["cc-by"], ["cc-by-nc-sa"], ["cc-by-nc", "cc-by-sa"],
    ]
    assert [found[10 + k] for k in range(len(licenses.TEMPLATES))] == [[v] for v in licenses.TEMPLATES.values()]


def test_long_template(documents):
    long = [f"w{i}" for i in range(300)]
    rows = [(1, "x " * 77 + " ".join(long)), (2, " ".join(long[:200])), (3, " ".join(long[::-1]))]
    found = got(licenses.scan(documents(rows), templates={" ".join(long): "long"}))
    assert [(r[6], r[8]) for r in found] == [("long", [(77, 377, "long", 1.0)]), ("", []), ("", [])]


def test_odd_rows(documents):
    long = "word é\x00é " * 50_000 + "general public license"
    rows = [(1, None), (2, ""), (None, "mit LICENSE"), (None, "mit LICENSE"), (3, long), (3, "\n"), (4, "éMIT license mit_license")]
    docs = documents(rows).selectExpr("*", "1 AS row", "2 AS labels", "3 AS blocks", "4 AS words")
    assert got(licenses.scan(docs)) == brute(rows)
    assert licenses.scan(documents([])).collect() == []


def test_matches_say_where(documents):
    rows = [(1, "x " * 300 + next(iter(licenses.TEMPLATES)))]
    found = licenses.scan(documents(rows)).collect()[0]
    assert [tuple(m) for m in found.matches] == [(300, 300 + len(SPLIT.findall(next(iter(licenses.TEMPLATES)))), "mit", 1.0)]
