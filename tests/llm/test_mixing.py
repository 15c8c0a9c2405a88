import hashlib
import random
from collections import defaultdict

import duckdb
import pytest

from hindcast.llm import mixing
from hindcast.llm.queries import OP1_SQL
from tests.llm.brute import words


def goals(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        held = {s for s in free if weight[s] * level >= limit * sizes[s]}
        if not held:
            return target | {s: weight[s] * level for s in free}
        for s in held:
            target[s] = limit * sizes[s]
            left -= target[s]
        free -= held
    return target


def brute(rows, weights=(5, 2, 1)):
    """(id, copy, words of that copy) of every document taken, for ids without repeats."""
    by_source = defaultdict(list)
    for i, text, source in rows:
        by_source[source].append((i, words(text)))
    sizes = {s: sum(len(w) for _, w in docs) for s, docs in by_source.items()}
    target, taken = goals(sizes, weights), []
    for source, docs in by_source.items():
        docs.sort(key=lambda d: hashlib.md5(f"mix:{'' if d[0] is None else d[0]}".encode()).hexdigest())
        left = int(target[source] + 0.5)
        for copy in (0, 1):
            for i, w in docs:
                here = w[: max(left, 0)]
                left -= len(here)
                if here:
                    taken.append((i, copy, here))
    return target, taken


def corpus(seed=1, n=90):
    rng = random.Random(seed)
    sources = ["a", "b", "Z", "é", None, "", "one"]
    return [
        (i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 5, 60, 700]))),
         "one" if i == 3 else rng.choice(sources[:6] + ["a"] * 6))
        for i in range(n)
    ]


def test_taken_words(documents):
    rows = corpus()
    target, taken = brute(rows)
    want = defaultdict(int)
    for i, _, w in taken:
        want[i] += len(w)
    sized = mixing.sizes(documents(rows))
    got = mixing.taken_words(mixing.mix(sized, block=16)).collect()
    source = {i: s for i, _, s in rows}
    assert {r.doc_id: r.taken for r in got} == {i: want[i] for i in source}
    assert all(abs(r.target - target[source[r.doc_id]]) < 1e-6 for r in got)
    assert all(r.taken <= 2 * r.size for r in got)


def test_slots_are_those_of_the_schedule(documents):
    sized = mixing.sizes(documents(corpus()))
    spans = mixing.mix(sized, block=8).where("copy IS NOT NULL").collect()
    slots = defaultdict(set)
    for r in spans:
        slots[r.slot].add((r.source, r.target))
    assert all(len(s) == 1 for k, s in slots.items() if k is not None)
    words_of = defaultdict(int)
    for r in spans:
        words_of[r.slot] += r.word_to - r.word_from
    assert max(n for s, n in words_of.items() if s is not None) <= 8
    total = {r.source: r.target for r in spans}
    # every beginning of the mix already has the sources in about the right shares
    scheduled = sorted(s for s in slots if s is not None)
    for part in (0.25, 0.5, 0.75):
        upto = scheduled[int(len(scheduled) * part)]
        for source, target in total.items():
            got = sum(r.word_to - r.word_from for r in spans if r.slot is not None and r.slot < upto and r.source == source)
            here = sum(n for s, n in words_of.items() if s is not None and s < upto)
            assert abs(got - here * target / sum(total.values())) <= 8 * 8, source


def test_nothing_but_what_slots_ask_for(documents, monkeypatch):
    docs = documents(corpus())
    sized = mixing.sizes(docs)
    spans = mixing.mix(sized, block=8).collect()
    assert all((r.slot is None) == (r.copy is None) == (r.word_to is None) for r in spans)
    plain = mixing.schedule
    monkeypatch.setattr(mixing, "schedule", lambda goals, block: plain(goals, block).where("slot >= 20"))
    fewer = mixing.mix(sized, block=8).where("slot IS NOT NULL").collect()
    words_of = sum(r.word_to - r.word_from for r in spans if r.slot is not None and r.slot >= 20)
    assert sum(r.word_to - r.word_from for r in fewer) == words_of
    monkeypatch.setattr(mixing, "schedule", lambda goals, block: plain(goals, block).where("false"))
    assert {r.taken for r in mixing.taken_words(mixing.mix(sized)).collect()} == {0}
    assert mixing.mixture(docs).collect() == []


def test_slots_by_hand(spark):
    """Bits of the points reversed, sources found by walking the stretches."""
    targets = [700.0, 3.0, 0.0, 41.4, 260.0]
    rows = [(f"0{i}", i, t) for i, t in enumerate(targets)]
    goals = spark.createDataFrame(rows, "key string, place int, target double")
    blocks = [-(-int(t + 0.5) // 8) for t in targets]
    n = sum(blocks)
    bits = (n - 1).bit_length()
    owner = {}
    for j in range(1 << bits):
        at = next(i for i in range(5) if j * n < sum(blocks[: i + 1]) << bits)
        owner[int(f"{j:0{bits}b}"[::-1], 2)] = at
    seen, want = [0] * 5, []
    for slot in sorted(owner):
        want.append((f"0{owner[slot]}", slot, seen[owner[slot]]))
        seen[owner[slot]] += 1
    assert sorted(tuple(r) for r in mixing.schedule(goals, 8).collect()) == sorted(want)
    assert all(s >= b for s, b in zip(seen, blocks, strict=True))


def test_mixture_in_the_order_of_the_schedule(documents):
    docs = documents(corpus(3))
    first = {r.doc_id: r.first_slot for r in mixing.taken_words(mixing.mix(mixing.sizes(docs))).collect()}
    seen = {}
    for place, r in enumerate(mixing.mixture(docs, ordered=True).collect()):
        seen.setdefault(r.doc_id, place)
    slots = [first[i] for i in sorted(seen, key=seen.get)]
    assert slots == sorted(slots)
    assert set(seen) == {i for i, s in first.items() if s is not None}


def test_documents_without_an_id(documents):
    rows = [(None, "a b", "x") for _ in range(400)]
    spans = mixing.mix(mixing.sizes(documents(rows)), block=4)
    got = mixing.taken_words(spans).collect()
    assert sum(r.taken for r in got) == 1200
    assert {r.taken for r in got} == {2, 4}


def test_mixture_has_the_words_taken(documents):
    rows = corpus(2)
    _, taken = brute(rows)
    docs = documents(rows).selectExpr("*", "1 AS row", "2 AS size", "3 AS cut", "4 AS key")
    mixed = mixing.mixture(docs, block=16)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    assert sorted((r.doc_id, words(r.text)) for r in got) == sorted((i, w) for i, _, w in taken)
    assert all(r.n_chars == len(r.text) for r in got)


def test_odd_rows(documents):
    long = "word " * 100_000
    rows = [(1, None, "a"), (2, "", "b"), (None, "x y", "a"), (None, "x y", "a"), (7, long, None), (7, long, None), (8, " \n", None)]
    sized = mixing.sizes(documents(rows))
    got = mixing.taken_words(mixing.mix(sized)).collect()
    assert len(got) == len(rows)
    target = goals({"a": 4, "b": 0, None: 200_000})
    by_size = {4: "a", 0: "b", 200_000: None}
    for size, source in by_size.items():
        here = [r for r in got if r.source_size == size]
        assert sum(r.taken for r in here) == int(target[source] + 0.5)
        assert all(abs(r.target - target[source]) < 1e-6 for r in here)


def test_empty_tables(documents):
    for rows in ([], [(1, None, "a"), (2, " ", None)]):
        sized = mixing.sizes(documents(rows))
        got = mixing.taken_words(mixing.mix(sized)).collect()
        assert [r.taken for r in got] == [0] * len(rows)
        assert mixing.mixture(documents(rows)).collect() == []


def test_share_above_the_limit_is_refused(documents):
    with pytest.raises(ValueError):
        mixing.targets(mixing.sizes(documents([(1, "a")])), share=3.0, limit=2.0)


def test_sql_says_the_same(spark, documents):
    rows = corpus(5)
    docs = documents(rows)
    got = mixing.taken_words(mixing.mix(mixing.sizes(docs)))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    found = con.execute(OP1_SQL)
    names = [c[0] for c in found.description]
    assert sorted(found.fetchall()) == sorted(tuple(r) for r in got.select(*names).collect())
