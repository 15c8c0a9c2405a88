import math
import random
from collections import Counter

import pytest

from hindcast.llm import rules
from tests.llm.brute import words

LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    times = Counter(tuple(w[p : p + 5]) for p in range(len(w) - 4))
    inside = {p + k for p in range(len(w) - 4) if times[tuple(w[p : p + 5])] > 1 for k in range(5)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    )


def grams(text):
    raw = b"\0" + (text or "").encode() + b"\0"
    if len(raw) == 2:
        return []
    if len(raw) < 4:
        return [int.from_bytes(raw, "big") * 2654435761 % 2**32 >> 16]
    return [
        int.from_bytes(raw[i : i + 4], "big") * 2654435761 % 2**32 >> 16 for i in range(len(raw) - 3)
    ]


def brute(rows, trusted, margin=0.2):
    raw = Counter(g for _, t in rows for g in grams(t))
    good = Counter(g for i, t in rows if i in trusted for g in grams(t))
    size, n, m = 1 << 16, sum(raw.values()), sum(good.values())
    table = lambda g: math.log((good[g] + 1) / (m + size)) - math.log((raw[g] + 1) / (n + size))
    found = []
    for i, t in rows:
        counts, own = brute_counts(t), grams(t)
        ratio = sum(map(table, own)) / len(own) if own and m else 0.0
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        found.append((i, *counts, round(ratio, 9), failed, not failed and ratio >= -margin))
    return sorted(found, key=str)


def got(frame):
    return sorted(((*r[:6], round(r[6], 9), *r[7:]) for r in frame.collect()), key=str)


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(80):
        w = rng.choices(["the", "thing", "éà", "ou", "la"], k=rng.choice([0, 3, 12, 300]))
        if i % 4 == 0:
            w = [rng.choice(["$$$", "#Q|"]) + x.upper() for x in w]
        if i % 7 == 0:
            w += w
        rows.append((i, "".join(x + rng.choice([" ", "\n", " \t"]) for x in w)))
    return rows


def test_same_as_brute_force(spark, documents):
    rows = [*corpus(), (200, None), (201, ""), (None, "x y " * 9), (202, "a"), (203, "ab"), (7, "again " * 30)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(60)] + [(None, 1, 0), (61, None, 0), (999, 1, 0)]
    trusted = {i for i, q, _ in labels if q == 1 and i is not None}
    frame = rules.rules(documents(rows), spark.createDataFrame(labels, LABELS))
    assert got(frame) == brute(rows, trusted)
    verdict = {r.doc_id: r.kept for r in frame.collect() if r.n_words >= 200 and not r.base_failed}
    assert verdict == {i: i % 4 != 0 for i in verdict} and len(set(verdict.values())) == 2


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)]])
def test_without_trusted_text_the_plain_rules_decide(spark, documents, labels):
    rows = corpus()
    frame = rules.rules(documents(rows), spark.createDataFrame(labels, LABELS))
    assert got(frame) == brute(rows, set())


def test_long_texts_empty_tables_and_extra_columns(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60_000))
    docs = documents([(1, long), (1, long), (2, "short")])
    docs = docs.selectExpr("*", "1 AS id", "2 AS doc", "3 AS trusted", "4 AS n_words", "5 AS ratio")
    assert got(rules.rules(docs, labels)) == brute([(1, long), (1, long), (2, "short")], {1})
    kept = rules.passing(docs, labels)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [1, 1]
    assert rules.rules(documents([]), labels).collect() == []


def test_all_trusted_documents_count(spark, documents):
    rows = [(i, f"text {i} of many") for i in range(20_050)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows], LABELS)
    assert not rules.ratios(documents(rows), labels).any()


def test_filter_keeps_every_id_and_drops_most_others(spark):
    rows = spark.range(5000).selectExpr("IF(id = 17, NULL, id) AS doc_id", "CAST(id AS STRING) AS text")
    ids = spark.range(0, 5000, 3).toDF("id")
    kept = {r.doc_id for r in rules._sifted(rows, ids).collect()}
    assert kept >= set(range(0, 5000, 3)) and len(kept) < 1700
    assert rules._sifted(rows, ids.limit(0)).count() == 0


def test_ratios_do_not_hang_on_how_spark_joins(spark, documents):
    rows, labels = documents([(k, f"some words {k % 7} here") for k in range(60)]), [(k, int(k % 3 == 0)) for k in range(40)]
    labels = spark.createDataFrame([(k, q, 0) for k, q in labels], "doc_id long, quality int, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    for limit in ("-1", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        found.append(rules.ratios(rows, labels))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (found[0] == found[1]).all() and found[0].any()
