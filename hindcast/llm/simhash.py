"""SimHash near-duplicates, found with fuzzy hashes from the binary Golay code.

The perfect Golay code puts every 23-bit word within three bits of exactly one codeword, so the
codeword's number is a hash of 12 bits that forgives small errors. Two words one bit apart need not
decode alike, but the codewords of one word's whole neighbourhood (at most 6) include the other's.

A fingerprint is cut into three segments. Of two differing bits or fewer, at least one segment has
none and the one after it (in a circle) at most one. So fingerprints within two bits share, for
some segment, that segment itself and a codeword around the next. Every pair that shares such a
key is compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import LOWER, Scratch, column_or_null, kept, sliced, texts
from hindcast.llm.components import components

#: Generator of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
#: Lowest bit and width of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
MOST_BITS = 2


def fingerprints(
    docs: DataFrame, *, shingle: int = 3, seed: int = 42, numbered: bool = False
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (long) of every document; ``row`` too if ``numbered``.

    A bit is set if it is in more than half of the XXH64 hashes of the lower-cased word shingles,
    repeats included. With fewer words than a shingle the whole sequence is the shingle; without
    words (null, empty or blank texts) the fingerprint is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [_fingerprint(t.translate(LOWER).split(), shingle, seed) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.array(found, pa.int64())],
                [*carried, "fingerprint"],
            )

    carried = ["row", "doc_id"] if numbered else ["doc_id"]
    number = ["row"] if numbered else []
    rows = docs.select(*number, column_or_null(docs, "doc_id", "long"), "text")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*carried, "fingerprint"]))


def links(prints: DataFrame, *, max_bits: int = MOST_BITS) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints that differ in at most ``max_bits`` bits, once.

    ``prints`` has a ``fingerprint`` column without repeats. The method covers up to two bits.
    """
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError("the keys are made for up to two differing bits")
    keys = prints.select("fingerprint").mapInArrow(
        _keys, "fingerprint long, exact array<long>, around array<long>"
    )
    keys = kept(keys, "golay-keys")
    one = keys.select(F.col("fingerprint").alias("a"), F.explode("exact").alias("key"))
    other = keys.select(F.col("fingerprint").alias("b"), F.explode("around").alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits)
    pairs = one.join(other, "key").where(near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, max_bits: int = MOST_BITS, seed: int = 42
) -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id``.

    The component is the smallest id that can be reached over links. Equal fingerprints are one
    node, so copies add no links. Rows of a repeated id share that id; where a component has no id
    but null, its ``component_id`` is null. An empty table gives an empty result.
    """
    # Both sides of a join are tables, so that adaptive execution can split a large component, or a
    # fingerprint with very many copies; below an aggregate it could not.
    scratch = Scratch(docs.sparkSession, "simhash")
    with scratch:
        prints = scratch.keep(fingerprints(docs, shingle=shingle, seed=seed))
        classes = scratch.keep(_classes(prints, max_bits))
        least = scratch.keep(classes.groupBy("component").agg(F.min("first").alias("component_id")))
        named = classes.join(least.hint("merge"), "component")
        named = scratch.keep(named.select("fingerprint", "component_id"))
        found = prints.join(named.hint("merge"), "fingerprint").select(
            "doc_id",
            F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
        return kept(found, "simhash-result")


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """Per fingerprint its least id, ``first``, and ``component``, the least fingerprint linked."""
    classes = kept(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprint-classes"
    )
    groups = components(links(classes, max_bits=max_bits)).withColumnRenamed("node", "fingerprint")
    return classes.join(groups, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )


def without_near_duplicates(
    docs: DataFrame, *, shingle: int = 3, max_bits: int = MOST_BITS, seed: int = 42
) -> DataFrame:
    """One document of each component, the first by id (null last), with the columns of the input.

    Of rows of the component that repeat the first id, or have none where no row has one, the one
    stays whose text comes first. Rows are numbered, so what an id does elsewhere does not matter.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = kept(docs.select(F.monotonically_increasing_id().alias("row"), whole), "numbered-documents")
    named = [F.col("doc")[c].alias(c) for c in ("doc_id", "text") if c in docs.columns]
    prints = fingerprints(rows.select("row", *named), shingle=shingle, seed=seed, numbered=True)
    prints = kept(prints, "fingerprints")
    members = prints.join(_classes(prints, max_bits).select("fingerprint", "component"), "fingerprint")
    members = kept(members.select("row", "doc_id", "component"), "members")
    least = members.groupBy("component").agg(F.min("doc_id").alias("least"))
    first = members.join(least, "component").where(F.col("doc_id").eqNullSafe(F.col("least")))
    found = first.groupBy("component").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    found = kept(found, "firsts")
    tied = first.join(found.where("n > 1").select("component"), "component").select("component", "row")
    order = ["text", *[c for c in docs.columns if c != "text"]]
    order = F.struct(*[F.col("doc")[c].alias(c) for c in order])
    tied = tied.join(rows, "row").groupBy("component").agg(
        F.min(F.struct(order.alias("doc"), F.col("row").alias("row"))).alias("kept")
    )
    stays = found.where("n = 1").select("row").union(tied.select("kept.row"))
    return rows.join(stays, "row", "left_semi").select("doc.*")


def _fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [words]
    else:
        parts = zip(*[words[i:] for i in range(shingle)], strict=False)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(p), seed) for p in parts], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big", signed=True)


def _remainders(bits: np.ndarray) -> np.ndarray:
    """Of 23-bit words, divided by the generator."""
    rest = bits.copy()
    for top in range(22, 10, -1):
        rest ^= np.where(rest >> top & 1, GENERATOR << (top - 11), 0)
    return rest


class Golay:
    """Numbers of the nearest codewords of 23-bit words."""

    def __init__(self) -> None:
        one = 1 << np.arange(23)
        errors = np.array(
            [0, *one]
            + [one[i] | one[j] for i in range(23) for j in range(i)]
            + [one[i] | one[j] | one[k] for i in range(23) for j in range(i) for k in range(j)]
        )
        self.error = np.empty(2048, dtype=np.int64)
        self.error[_remainders(errors)] = errors
        # The remainder is linear: that of a word is that of its halves, combined.
        self.low = _remainders(np.arange(2048))
        self.high = _remainders(np.arange(4096) << 11)

    def number(self, bits: np.ndarray) -> np.ndarray:
        remainder = self.high[bits >> 11] ^ self.low[bits & 2047]
        return (bits ^ self.error[remainder]) >> 11


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code = Golay()
    for batch in sliced(batches, 20_000):
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        exact, around = [], []
        for i, (low, width) in enumerate(SEGMENTS):
            whole = (prints >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1)
            low, width = SEGMENTS[(i + 1) % 3]
            fuzzy = (prints >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1)
            base = (whole << 2 | i) << 12
            exact.append(base | code.number(fuzzy))
            flipped = [fuzzy] + [fuzzy ^ (1 << k) for k in range(width)]
            around += [base | code.number(f) for f in flipped]
        around = np.sort(np.stack(around, axis=1), axis=1)
        fresh = np.ones(around.shape, dtype=bool)
        fresh[:, 1:] = around[:, 1:] != around[:, :-1]
        ends = np.concatenate(([0], np.cumsum(fresh.sum(axis=1))))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("fingerprint"),
                pa.ListArray.from_arrays(
                    np.arange(0, 3 * len(prints) + 1, 3, dtype=np.int32),
                    np.stack(exact, axis=1).ravel(),
                ),
                pa.ListArray.from_arrays(ends.astype(np.int32), around[fresh]),
            ],
            ["fingerprint", "exact", "around"],
        )
