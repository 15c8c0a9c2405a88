"""Removal of word windows that occur earlier in the corpus, by level-wise doubling.

A window of 20 words can only be repeated if the windows of 10 words inside it are. So windows of 10
words are counted first, and only where they have a partner are they extended to 20; longer windows
double as often as it takes. A level need not look at all windows inside a long one: one of them,
the one with the least hash, stands for the long window, and since it is chosen by content alone,
equal long windows are represented alike. Only about 2 in 12 windows of 10 words are ever shuffled,
and the last level only meets text that is most likely repeated.

Documents whose words are all equal need no windows: all but the first are removed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import Scratch, column_or_null, kept, sliced, texts

#: Words whose hashes a Python worker remembers.
REMEMBERED = 400_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Mixed into the word hashes for the second part of a window's hash, which has 96 bits in all.
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
KEY = ["doc_id", "mark"]


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _windows(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of so many words, the first at position 0.

    The hash of a window is that of its first half times a power of the factor, plus that of the
    rest; so powers of two are built by doubling and put together.
    """
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    found, done = None, 0
    part, size, factor = words, 1, FACTOR
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                here = part[done : done + count]
                found = here if found is None else found * factor + here
                done += size
            if done == length:
                break
            part = part[:-size] * factor + part[size:]
            size, factor = size * 2, factor * factor
        found = found ^ (found >> np.uint64(29))
        return found * FACTOR


def _anchors(words: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each long window the place of the short one that stands for it; hashes of short ones."""
    short = _windows(words, length)
    many = max(len(words) - window + 1, 0)
    least, place = short[:many].copy(), np.arange(many)
    less = np.empty(many, dtype=bool)
    for k in range(1, window - length + 1 if many else 0):
        here = short[k : k + many]
        np.less(here, least, out=less)
        np.copyto(least, here, where=less)
        np.copyto(place, np.arange(k, k + many), where=less)
    return place, short


def _levels(window: int, shortest: int) -> list[int]:
    """Lengths of the levels below the window's own."""
    found = [min(shortest, window - 1)]
    while found[-1] * 2 < window:
        found.append(found[-1] * 2)
    return found


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(ends, pa.array(flat, kind))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _first_level(
    batches: Iterator[pa.RecordBatch], length: int, window: int
) -> Iterator[pa.RecordBatch]:
    """Number of words, their digest and the anchors of the first level, per document."""
    memory = _Hashes()
    row = TaskContext.get().partitionId() << 40
    nothing = np.zeros(0, dtype=np.uint64)
    for batch in sliced(batches, 200):
        counts, digests, hashes, places = [], [], [], []
        for text in texts(batch):
            words = text.split()
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).digest())
            long_enough = memory.of(words) if len(words) >= window else nothing
            at, short = _anchors(long_enough, length, window)
            at = np.unique(at)
            hashes.append(_signed(short[at]))
            places.append(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(row, row + len(counts)), pa.int64()),
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                _lists(hashes, pa.int64()),
                _lists(places, pa.int32()),
            ],
            ["row", *KEY, "n_words", "digest", "hashes", "places"],
        )
        row += len(counts)


def _next_level(
    batches: Iterator[pa.RecordBatch], passed: list[int], length: int, window: int
) -> Iterator[pa.RecordBatch]:
    """Anchors of a level, or whole windows at the last, of the windows that passed so far.

    ``passed`` of the input holds, for each level passed, the anchors that are repeated.
    """
    memory = _Hashes()
    for batch in sliced(batches, 50):
        hashes, more, places = [], [], []
        for text, repeated in zip(texts(batch), batch.column("passed").to_pylist(), strict=True):
            words = memory.of(text.split())
            alive = np.ones(max(len(words) - window + 1, 0), dtype=bool)
            for n, these in zip(passed, repeated, strict=True):
                is_repeated = np.zeros(len(words) + 1, dtype=bool)
                is_repeated[these] = True
                alive &= is_repeated[_anchors(words, n, window)[0]]
            if length < window:
                at, short = _anchors(words, length, window)
                at = np.unique(at[alive])
                more.append(np.zeros(0, dtype=np.int32))
            else:
                at, short = np.flatnonzero(alive), _windows(words, window)
                mixed = (words ^ (words >> np.uint64(31))) * OTHER
                second = _windows(mixed ^ (mixed >> np.uint64(27)), window)[at]
                more.append((second >> np.uint64(32)).astype(np.uint32).view(np.int32))
            hashes.append(_signed(short[at]))
            places.append(at)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("rank"),
                _lists(hashes, pa.int64()),
                _lists(more, pa.int32()),
                _lists(places, pa.int32()),
            ],
            ["rank", "hashes", "more", "places"],
        )


def _cut(
    batches: Iterator[pa.RecordBatch], window: int, with_text: bool
) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 50):
        removed, digests, left = [], [], []
        for text, starts in zip(texts(batch), batch.column("starts").to_pylist(), strict=True):
            words = text.split()
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            edge[starts] += 1
            edge[np.asarray(starts) + window] -= 1
            stays = np.cumsum(edge)[:-1] == 0
            rest = b" ".join([words[i] for i in np.flatnonzero(stays)])
            removed.append(int(len(words) - stays.sum()))
            digests.append(hashlib.sha256(rest).hexdigest())
            left.append(rest.decode() if with_text else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(left, pa.string()),
            ],
            [*KEY, "n_removed", "kept_sha256", "left"],
        )


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["mark"] == right["mark"])


def _marked(docs: DataFrame) -> DataFrame:
    """Documents told apart by id and a hash of the text, since ids may repeat or be null."""
    return docs.select(
        column_or_null(docs, "doc_id", "long"), F.xxhash64("text").alias("mark"), "text"
    )


def _repeated(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Of (key, hash, place) rows those whose hash occurs more than once, as lists per key.

    The hashes are written before they are joined, so that Spark can split the rows of one that
    occurs very often among tasks.
    """
    counts = rows.groupBy("hash").agg(F.count("*").alias("n"))
    often = scratch.keep(counts.where("n > 1").select("hash"))
    found = rows.join(often.hint("merge"), "hash")
    return found.groupBy(key).agg(F.collect_set("place").alias("places"))


def _exploded(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    found = rows.select(key, F.explode(F.arrays_zip(*fields)).alias("w"))
    names = {"hashes": "hash", "places": "place"}
    return found.select(key, *[F.col(f"w.{f}").alias(names.get(f, f)) for f in fields])


def removals(
    docs: DataFrame, *, window: int = 20, shortest: int = 10, with_text: bool = False
) -> DataFrame:
    """Per document: ``doc_id``, ``mark``, ``n_words``, ``n_removed``, ``kept_sha256``, ``left``.

    A word is removed if a window around it also starts earlier: in a document of a smaller id
    (null comes last), or further up in the same one. Rows with the same id and text, also with a
    null id, are one document and get the same result; of different texts with the same id the one
    with the smaller hash comes first. Null and blank texts have no words; shorter texts than a
    window stay. ``left`` is the text that stays where something was removed, if ``with_text``.
    ``shortest`` is the length of the first level.
    """
    if window < 2 or shortest < 1:
        raise ValueError("a window needs two words at least, the shortest one a word")
    lengths = _levels(window, shortest)
    with Scratch(docs.sparkSession, "substring") as scratch:
        return kept(_removals(docs, window, lengths, with_text, scratch), "substring-result")


def _removals(
    docs: DataFrame, window: int, lengths: list[int], with_text: bool, scratch: Scratch
) -> DataFrame:
    marked = _marked(docs)
    base = scratch.keep(
        marked.mapInArrow(
            partial(_first_level, length=lengths[0], window=window),
            "row long, doc_id long, mark long, n_words long, digest binary, "
            "hashes array<long>, places array<int>",
        )
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    firsts = base.groupBy("digest").agg(F.min(order).alias("first"))
    facts = scratch.keep(
        base.select("row", *KEY, "n_words", "digest")
        .join(firsts, "digest")
        .withColumn("copy", (order > F.col("first")) & (F.col("n_words") >= window))
        .drop("first")
    )
    originals = facts.where(f"NOT copy AND n_words >= {window}")
    originals = originals.groupBy(*KEY).agg(F.min("row").alias("row"))
    # Sorted over all partitions, so that the numbers given in them are in the documents' order.
    in_order = [F.col("doc_id").asc_nulls_last(), F.col("mark")]
    originals = originals.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    originals = scratch.keep(originals.withColumn("rank", F.monotonically_increasing_id()))

    anchors = _exploded(base.where(f"n_words >= {window}"), "row", "hashes", "places")
    repeated = scratch.keep(_repeated(anchors, "row", scratch).join(originals, "row"))
    rows = scratch.keep(
        marked.join(repeated, _same(marked, repeated)).select(
            "rank", marked["doc_id"], marked["mark"], "text", F.array("places").alias("passed")
        )
    )
    scratch.drop(base)
    schema = "rank long, hashes array<long>, more array<int>, places array<int>"
    for k, length in enumerate(lengths[1:], 1):
        run = partial(_next_level, passed=lengths[:k], length=length, window=window)
        level = scratch.keep(rows.mapInArrow(run, schema))
        found = _exploded(level, "rank", "hashes", "places")
        repeated = scratch.keep(_repeated(found, "rank", scratch))
        passed = F.concat("passed", F.array("places")).alias("passed")
        rows = scratch.keep(rows.join(repeated, "rank").select("rank", *KEY, "text", passed))
    run = partial(_next_level, passed=lengths, length=window, window=window)
    last = scratch.keep(rows.mapInArrow(run, schema))
    last = _exploded(last, "rank", "hashes", "more", "places")
    at = F.struct("rank", "place")
    early = last.groupBy("hash", "more").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    early = scratch.keep(early.where("n > 1").drop("n"))
    later = last.join(early.hint("merge"), ["hash", "more"]).where(at > F.col("first"))
    later = scratch.keep(later.groupBy("rank").agg(F.collect_set("place").alias("starts")))
    cut = rows.join(later, "rank").select("rank", *KEY, "text", "starts").dropDuplicates(["rank"])
    cut = cut.mapInArrow(
        partial(_cut, window=window, with_text=with_text),
        "doc_id long, mark long, n_removed long, kept_sha256 string, left string",
    )
    whole = facts["copy"]
    return facts.join(cut, _same(facts, cut), "left").select(
        facts["doc_id"],
        facts["mark"],
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("left")).alias("left"),
    )


def without_repeats(docs: DataFrame, *, window: int = 20) -> DataFrame:
    """The documents without their removed words, with the columns of the input.

    A document that loses words holds the others joined by one space, and ``n_chars``, where there
    is one, counts them; one that loses all is dropped. The others stay as they are.
    """
    found = removals(docs, window=window, with_text=True).where("n_removed > 0")
    found = found.select(
        F.col("doc_id").alias("id"), F.col("mark").alias("mark"), F.col("left").alias("left")
    ).distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        F.xxhash64("text").alias("mark"),
        column_or_null(docs, "doc_id", "long").alias("id"),
    )
    same = rows["id"].eqNullSafe(found["id"]) & (rows["mark"] == found["mark"])
    joined = rows.join(found, same, "left").where("left IS NULL OR left <> ''")
    instead = {"text": F.coalesce("left", F.col("doc.text"))}
    if "n_chars" in docs.columns:
        chars = F.length("left").cast(dict(docs.dtypes)["n_chars"])
        instead["n_chars"] = F.coalesce(chars, F.col("doc.n_chars"))
    return joined.select(*[instead.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
