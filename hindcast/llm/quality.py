"""Text quality by compression: which of two dictionaries makes a text smaller?

One zstandard dictionary is built from text labelled good, one from text labelled bad. Each text is
compressed in blocks with both; the difference of the sizes per byte says which class it is made
like. A logistic curve over that difference, fitted on labelled texts that went into neither
dictionary, turns it into a probability. The curve also sees the size per byte itself, since text
that repeats one word shrinks under any dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.common import column_or_null, sliced, texts, training_side

#: Bytes compressed together. Short blocks keep a dictionary's influence on long texts.
BLOCK = 1024
DICTIONARY = 1 << 18
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve; small enough to go to every task."""

    good: bytes
    bad: bytes
    trained: tuple[bool, bool]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def scores(self, found: list[bytes]) -> np.ndarray:
        x = (self.features(found) - np.array(self.centre)) / np.array(self.scale)
        z = np.column_stack([x, np.ones(len(x))]) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def features(self, found: list[bytes]) -> np.ndarray:
        return _features(found, _compressor(self.good, self.trained[0]), _compressor(self.bad, self.trained[1]))


def _kind(trained: bool) -> int:
    return zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT


@cache
def _compressor(dictionary: bytes, trained: bool) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=_kind(trained)) if dictionary else None
    if held:
        held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False
    )


def _blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def _features(found: list[bytes], good, bad) -> np.ndarray:
    """Size difference per byte, size per byte, its square, logarithm of the length."""
    rows = []
    for text in found:
        text = text or b" "
        parts = _blocks(text)
        by_good = sum(len(good.compress(p)) for p in parts) / len(text)
        by_bad = sum(len(bad.compress(p)) for p in parts) / len(text)
        least = min(by_good, by_bad)
        rows.append((by_bad - by_good, least, least * least, np.log(len(text))))
    return np.array(rows, dtype=float).reshape(-1, 4)


def _dictionary(found: list[bytes]) -> tuple[bytes, bool]:
    """Trained, or the text itself where there is too little to train on."""
    parts = [p for text in found for p in _blocks(text)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:], False


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    modulus: int = 5,
    held_out: int = 0,
    sample: int = 1500,
    longest: int = 16_384,
) -> Model:
    """Learn from a bounded sample of the labelled rows that are not held out.

    ``sample`` rows of each class, in the order of a hash of their id, with at most ``longest``
    characters; longer texts are not learnt from. The classes' shares among all labelled rows are
    restored by weights. If a class is missing, every text gets the smoothed share of good labels.
    """
    learn = labels.where(training_side(labels["doc_id"], modulus, held_out)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    learn = learn.where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    short = rows.where((F.length("text") > 0) & (F.length("text") <= longest))
    usable = learn.join(short.select("doc_id"), "doc_id", "left_semi")
    order = F.md5(F.col("doc_id").cast("string"))
    share = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for k in (0, 1):  # at most ``sample`` rows each, so their ids can be broadcast
        one = usable.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample)
        chosen = one if chosen is None else chosen.union(one)
    # An id on many rows gives its least text, so what is collected is bounded too.
    got = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    got = got.agg(F.min("text").alias("text")).collect()
    got.sort(key=lambda r: (r["doc_id"], r["label"], r["text"]))
    by_class = [[r["text"].encode() for r in got if r["label"] == k] for k in (0, 1)]
    prior = (share.get(1, 0) + 1) / (sum(share.values()) + 2)
    nothing = (0.0,) * 4
    if min(map(len, by_class)) < 4:
        return Model(b"", b"", (False, False), nothing, (1.0,) * 4, (*nothing, float(np.log(prior / (1 - prior)))))
    (bad, bad_trained), (good, good_trained) = (_dictionary(c[::2]) for c in by_class)
    left = [t for c in by_class for t in c[1::2]]
    y = np.repeat([0.0, 1.0], [len(c[1::2]) for c in by_class])
    x = _features(left, _compressor(good, good_trained), _compressor(bad, bad_trained))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    each = [share[k] / len(by_class[k][1::2]) for k in (0, 1)]
    weights = _curve((x - centre) / scale, y, np.where(y == 1, each[1], each[0]))
    return Model(
        good, bad, (good_trained, bad_trained),
        tuple(centre.tolist()), tuple(scale.tolist()), tuple(weights.tolist()),
    )


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, lightly regularised; the constant is last."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = weight * (len(y) / weight.sum())
    found = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -50, 50)))
        slope = x.T @ (weight * (y - p)) - ridge * found
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        found += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return found


def score(
    docs: DataFrame, model: Model, *, threshold: float = 0.3, modulus: int = 5, held_out: int = 0
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (probability of good), ``predicted``.

    The score sees the text alone; null and empty texts score as a single blank. Repeated rows
    score alike; an empty table gives an empty result.
    """
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    found = rows.mapInArrow(_scorer(model, ["doc_id"]), "doc_id long, score double")
    return found.select(
        "doc_id",
        (~training_side(F.col("doc_id"), modulus, held_out)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, model: Model, *, threshold: float = 0.3) -> DataFrame:
    """The rows that score at least the threshold, with the columns of the input."""
    whole = docs.select(
        F.col("text"), F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    )
    schema = T.StructType().add("doc", docs.schema).add("score", T.DoubleType())
    found = whole.mapInArrow(_scorer(model, ["doc"]), schema)
    return found.where(F.col("score") >= threshold).select("doc.*")


def _scorer(model: Model, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = pa.array(model.scores(texts(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], scores], [*carried, "score"]
            )

    return run
