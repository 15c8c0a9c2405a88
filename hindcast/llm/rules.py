"""Quality rules: counts of a text, and how much it reads like trusted text.

Every text is cut into overlapping byte n-grams, hashed into buckets. One multinomial over the
buckets is that of all documents, one that of trusted ones; the logarithm of their ratio, averaged
over a text's n-grams, says which of the two it is likelier from, whatever its length. A text is
rejected if it is likelier from the raw corpus by more than a fixed margin, or fails a plain rule.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.common import column_or_null, sliced, texts
from hindcast.llm.substring import _Hashes, _windows

SYMBOLS = b"#*$%&|<>"
#: Bytes in an n-gram, and bits of its bucket.
GRAM = 4
BITS = 16
#: Bits of the filter of trusted ids, as a power of two.
SIFT = 24
#: Buckets whose counts share a row, and lots in which tasks' counts are added up first.
CHUNK, LOTS = 4096, 256
COUNTED = "chunk int, lot int, buckets array<int>, n array<long>"
#: Words in the windows whose repetition within a text counts.
REPEATED = 5
COUNTS = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"


def _buckets(text: bytes) -> np.ndarray:
    """Buckets of the n-grams of a text between two zero bytes; none if it is empty."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(b"\0" + text + b"\0", dtype=np.uint8).astype(np.uint32)
    many = max(len(raw) - GRAM + 1, 1)
    value = np.zeros(many, dtype=np.uint32)
    for k in range(min(GRAM, len(raw))):
        value = value << np.uint32(8) | raw[k : k + many]
    return (value * np.uint32(2654435761) >> np.uint32(32 - BITS)).astype(np.int64)


def ratios(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    smoothing: float = 1.0,
) -> np.ndarray:
    """Log ratio of trusted to raw probability, by bucket.

    Raw counts are those of all documents. Trusted are all documents labelled 1. Without trusted
    text all ratios are 0.
    """
    trusted = labels.where(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("id"))
    trusted = trusted.where("id IS NOT NULL").distinct()
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    # Texts are only shuffled if they may be trusted, and always in the same way, whatever the sizes.
    maybe = _sifted(rows, trusted).join(trusted.hint("merge"), F.col("doc_id") == F.col("id"))
    found = None
    for part, side in ((rows, 0), (maybe, 1)):
        counted = part.select("text").mapInArrow(_count, COUNTED).withColumn("side", F.lit(side))
        found = counted if found is None else found.union(counted)
    # Counts travel as arrays, some rows a task, and are added up in two steps: of 256 lots, then all.
    for keys in (("side", "chunk", "lot"), ("side", "chunk")):
        found = found.groupBy(*keys).applyInArrow(_added, f"{COUNTED}, side int")
    counts = np.zeros((2, 1 << BITS))
    for r in found.collect():  # a row per chunk of buckets
        counts[r["side"], r["buckets"]] = r["n"]
    if not counts[1].any():
        return np.zeros(1 << BITS)
    shares = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.log(shares[1]) - np.log(shares[0])


def _sifted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is among ``ids``, and a few others: a bit per hash, sent to all tasks.

    The filter has 2^SIFT bits however many ids there are: 2 MB. The more ids, the more others pass.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(1 << SIFT))
    bits = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    mine = F.pmod(F.xxhash64("doc_id"), F.lit(1 << SIFT))
    rows = rows.where("doc_id IS NOT NULL").withColumn("place", mine)
    rows = rows.withColumn("bucket", F.bitmap_bucket_number("place"))
    rows = rows.join(F.broadcast(bits), "bucket")
    byte = "CAST(conv(hex(substring(bits, CAST(bitmap_bit_position(place) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return rows.where(f"shiftright({byte}, CAST(bitmap_bit_position(place) % 8 AS INT)) & 1 = 1").select("doc_id", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for batch in sliced(batches):
        held: list[np.ndarray] = []
        size = 0
        for text in texts(batch):
            held.append(_buckets(text))
            size += len(held[-1])
            if size > 1 << 20:
                counts += np.bincount(np.concatenate(held), minlength=1 << BITS)
                held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=1 << BITS)
    yield _packed(counts, TaskContext.get().partitionId() % LOTS)


def _packed(counts: np.ndarray, lot: int) -> pa.RecordBatch:
    """Counts above zero, a row for each chunk of buckets that has some."""
    used = np.flatnonzero(counts)
    chunks, first = np.unique(used // CHUNK, return_index=True)
    edges = pa.array(np.append(first, len(used)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunks, pa.int32()),
            pa.array(np.full(len(chunks), lot), pa.int32()),
            pa.ListArray.from_arrays(edges, pa.array(used, pa.int32())),
            pa.ListArray.from_arrays(edges, pa.array(counts[used], pa.int64())),
        ],
        ["chunk", "lot", "buckets", "n"],
    )


def _added(rows: pa.Table) -> pa.Table:
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for batch in rows.to_batches():
        np.add.at(counts, batch.column("buckets").flatten().to_numpy(), batch.column("n").flatten().to_numpy())
    side = rows.column("side")[0].as_py()
    found = pa.Table.from_batches([_packed(counts, 0)])
    return found.append_column("side", pa.array([side] * len(found), pa.int32()))


def _measures(text: bytes, memory: _Hashes) -> tuple[int, int, int, int, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words, memory),
    )


def _repeated_words(words: list[bytes], memory: _Hashes) -> int:
    """Words in windows found twice or more; hashes only find the windows to look at."""
    if len(words) <= REPEATED:
        return 0
    _, kind, times = np.unique(
        _windows(memory.of(words), REPEATED), return_inverse=True, return_counts=True
    )
    maybe = np.flatnonzero(times[kind] > 1).tolist()
    if not maybe:
        return 0
    exact = Counter(tuple(words[p : p + REPEATED]) for p in maybe)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for p in maybe:
        if exact[tuple(words[p : p + REPEATED])] > 1:
            edge[p] += 1
            edge[p + REPEATED] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measured(docs: DataFrame, table: np.ndarray, columns: list[str]) -> DataFrame:
    """These columns as a struct ``doc``, with the counts and ``ratio``, the mean log ratio.

    Null and empty texts have counts and ratio 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Hashes()
        for batch in sliced(batches):
            found = texts(batch)
            counts = [_measures(t, memory) for t in found]
            ratio = [float(shared.value[b].mean()) if len(b := _buckets(t)) else 0.0 for t in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))],
                    pa.array(ratio, pa.float64()),
                ],
                ["doc", *COUNTS, "ratio"],
            )

    schema = T.StructType().add("doc", docs.select(*[docs[c] for c in columns]).schema)
    for name in COUNTS:
        schema = schema.add(name, T.LongType())
    carried = F.struct(*[docs[c] for c in columns]).alias("doc")
    return docs.select("text", carried).mapInArrow(run, schema.add("ratio", T.DoubleType()))


def judged(rows: DataFrame, *, margin: float = 0.2) -> DataFrame:
    """With ``base_failed`` (too few words, or too many in repeated windows) and ``kept``."""
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= -margin))


def rules(docs: DataFrame, labels: DataFrame, *, margin: float = 0.2, **how) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``ratio``, ``base_failed``, ``kept``.

    Repeated rows are judged alike; an empty table gives an empty result.
    """
    docs = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    found = judged(measured(docs, ratios(docs, labels, **how), ["doc_id"]), margin=margin)
    return found.select("doc.doc_id", *COUNTS, "ratio", "base_failed", "kept")


def passing(docs: DataFrame, labels: DataFrame, *, margin: float = 0.2, **how) -> DataFrame:
    """The rows that are kept, with the columns of the input."""
    found = measured(docs, ratios(docs, labels, **how), docs.columns)
    return judged(found, margin=margin).where("kept").select("doc.*")
