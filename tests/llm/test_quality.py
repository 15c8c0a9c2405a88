import random
import zlib

import pytest

from hindcast.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    parts = ["the", "and", "tion", "ing", "er", "on", "al", "re", "st", "ou"]
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 300))]
        if not good:
            words = [w.upper() + "!!" if i % 2 else w + rng.choice(["$$$", "***"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark, documents):
    rows, labels = corpus(400)
    table = spark.createDataFrame(labels, LABELS)
    docs = documents(rows)
    return docs, dict((i, q) for i, q, _ in labels), quality.fit(docs, table)


def test_held_out_accuracy(fitted):
    docs, label, model = fitted
    found = quality.score(docs, model).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in label if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    good = [r.score for r in held if label[r.doc_id]]
    bad = [r.score for r in held if not label[r.doc_id]]
    assert sum(good) / len(good) > 0.8 > 0.3 > sum(bad) / len(bad)


def test_labels_of_held_out_rows_are_not_seen(spark, fitted):
    docs, label, model = fitted
    turned = [
        (i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q in label.items()
    ]
    assert quality.fit(docs, spark.createDataFrame(turned, LABELS)) == model


def test_odd_rows(documents, fitted):
    _, _, model = fitted
    long = "therestingonal " * 60_000
    rows = [(1, None), (2, ""), (None, "the and"), (3, long), (3, long), (4, " "), (5, "é\x00")]
    docs = documents(rows).selectExpr("*", "1 AS score", "2 AS doc", "3 AS predicted")
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    blank = {r.score for r in found if r.doc_id in (1, 2, 4)}
    assert len(blank) == 1
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in found if r.predicted
    )
    assert quality.score(documents([]), model).collect() == []
    assert quality.good_documents(documents([]), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(i, 1, 0) for i in range(30)], [(1, None, 0), (None, 0, 0)]])
def test_without_two_classes_the_score_is_the_share(spark, documents, labels):
    docs = documents([(i, f"text {i}") for i in range(30)])
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    scores = {r.score for r in quality.score(docs, model).collect()}
    assert len(scores) == 1 and scores.pop() >= 0.5


def test_an_id_on_very_many_rows_teaches_once(spark):
    rows = [(k, ("clear prose about rivers " if k % 2 else "buy cheap $$$ now ") * (3 + k % 5)) for k in range(80)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(80)], "doc_id long, quality int, toxic int")
    plain = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    again = [(3, rows[3][1])] * 500 + [(3, "z" + rows[3][1])] * 500
    assert quality.fit(spark.createDataFrame(rows + again, "doc_id long, text string"), labels) == plain


def test_scores_by_hand(spark):
    """Sizes under both dictionaries, block by block, and the curve, computed without the library."""
    import math

    import zstandard

    rows = [(k, ("clear prose about rivers and %d hills " % k if k % 2 else "buy %d cheap $$$ now! " % k) * (3 + k % 70)) for k in range(90)]
    docs = spark.createDataFrame([*rows, (90, None), (91, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(90)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)

    def size(text, dictionary, trained):
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
        made = zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False, write_dict_id=False)
        return sum(len(made.compress(text[i : i + 1024])) for i in range(0, len(text), 1024)) / len(text)

    for r in quality.score(docs, model).join(docs, "doc_id").collect():
        text = (r.text or " ").encode()
        good, bad = size(text, model.good, model.trained[0]), size(text, model.bad, model.trained[1])
        x = (bad - good, min(good, bad), min(good, bad) ** 2, math.log(len(text)))
        z = model.weights[-1] + sum(
            w * (v - c) / s for w, v, c, s in zip(model.weights, x, model.centre, model.scale, strict=False)
        )
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
        assert r.predicted == (r.score >= 0.3)
