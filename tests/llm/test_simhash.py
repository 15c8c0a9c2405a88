import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from hindcast.llm import simhash
from tests.llm.brute import LOWER, groups, words


def brute_print(text, shingle=3):
    w = words((text or "").translate(LOWER))
    parts = [w[i : i + shingle] for i in range(len(w) - shingle + 1)] or [w]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts] if w else []
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b, is_set in enumerate(bits) if is_set)


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    near = [
        (a, b) for a, b in combinations(set(prints), 2) if (a ^ b).bit_count() <= 2
    ]
    root = groups(set(prints), near)
    first = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    return sorted(
        ((i, f"{p:016x}", first.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)),
        key=str,
    )


def got(spark_rows):
    return sorted((tuple(r) for r in spark_rows.collect()), key=str)


def test_same_as_brute_force(documents):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "Groß", "ÀB"]
    rows = []
    for i in range(150):
        if i % 3 and rows:
            w = list(words(rng.choice(rows)[1]))
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 40, 400]))
        rows.append((rng.randrange(10**6), " ".join(w)))
    rows += [(5, rows[0][1].upper()), (4, rows[0][1]), (4, rows[0][1])]
    found = got(simhash.near_duplicates(documents(rows)))
    assert found == brute(rows)
    assert len({r[2] for r in found}) < len(rows)


def test_odd_rows(documents):
    long = "ab cd\tef " * 30_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, long), (7, long), (8, long + "x"), (None, "q")]
    found = got(simhash.near_duplicates(documents(rows)))
    assert found == brute(rows)


def test_empty_table_and_extra_columns(spark, documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    rows = documents([(2, "a b c d"), (1, "a b c d"), (1, "a b c d"), (9, "z")])
    rows = rows.selectExpr("*", "1 AS fingerprint", "2 AS component_id", "3 AS stays", "4 AS again")
    kept = simhash.without_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 9]


def test_one_row_of_each_group_whatever_the_ids(documents):
    a, b, c = "one two three four", "five six seven eight", "nine ten eleven twelve"
    rows = [(None, a), (None, b), (None, c), (None, c), (5, "aa bb cc dd"), (5, "A0 ee ff gg"), (3, "a0 ee ff gg")]
    found = simhash.without_near_duplicates(documents(rows)).collect()
    want = [(None, a), (None, b), (None, c), (5, "aa bb cc dd"), (3, "a0 ee ff gg")]
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(want, key=str)


def test_every_error_of_two_bits_shares_a_key():
    rng = np.random.default_rng(1)
    prints = rng.integers(-(2**63), 2**63, 20, dtype=np.int64)
    masks = [0] + [1 << a for a in range(64)]
    masks += [1 << a | 1 << b for a, b in combinations(range(64), 2)]

    def keys(values, name):
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array(values, pa.int64())], ["fingerprint"])
        return sum((b.column(name).to_pylist() for b in simhash._keys(iter([batch]))), [])

    for p in prints.tolist():
        others = [((p ^ m) + 2**63) % 2**64 - 2**63 for m in masks]
        exact = set(keys([p], "exact")[0])
        assert all(exact & set(a) for a in keys(others, "around"))
        assert max(len(a) for a in keys(others, "around")) <= 18


def test_golay_numbers_are_those_of_the_nearest_codeword():
    code = simhash.Golay()
    data = np.arange(4096, dtype=np.int64)
    words_ = data << 11 | simhash._remainders(data << 11)
    assert (simhash._remainders(words_) == 0).all()
    for error in (0, 1, 1 << 22, 0b1011, 1 << 4 | 1 << 15 | 1 << 21):
        assert (code.number(words_ ^ error) == data).all()


def test_more_bits_are_refused(documents):
    with pytest.raises(ValueError):
        simhash.near_duplicates(documents([(1, "a")]), max_bits=3)
