"""Stretches of a text that repeat with a period: an enhanced suffix array's branching squares.

The words of many documents are laid end to end, each document with word numbers of its own, so
that nothing matches across documents. Ranks by prefix doubling give the suffix array and its
inverse; the ranks of every doubling also answer how far two places agree, forwards or backwards.
An interval of the array whose suffixes agree on ``depth`` words stands for a node of the suffix
tree, and no node is ever made: for each interval the suffixes of all children but the largest are
looked at, and where the suffix ``depth`` words on (or before) lies in the interval too, two equal
halves stand side by side and the next word differs, a branching square. Every run ends in exactly
one such square of its period. It is moved to the left word by word as long as it stays a square
(found by halving steps); squares that come to the same stretch are one run, its period the least.

Documents without any four words in a row that occur twice are left out before the array is built:
a run of twelve words or more has such words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import column_or_null, sliced, texts

#: Doublings after which documents without a repeat are left out: four words.
TESTED = 2
#: A run has at least this many words, so that it holds four words in a row twice.
LEAST = 2 * 2**TESTED - 1
#: Suffixes of smaller children looked at together.
TOGETHER = 1 << 22
RUNS = "array<struct<start: long, length: long, period: long>>"


class _Ranks:
    """Ranks of all places by their first 1, 2, 4, ... codes; equal ranks, equal codes.

    A rank is the number of suffixes that sort before its group. Only places whose rank is shared
    are sorted again, so text without repeats costs little.
    """

    def __init__(self, codes: np.ndarray, most: int | None = None) -> None:
        n = self.n = len(codes)
        times = np.bincount(codes) if n else np.zeros(0, dtype=np.int64)
        rank = (np.cumsum(times) - times)[codes] if n else times
        self.levels = [rank.astype(np.int32)]
        self.shared = np.flatnonzero(times[codes] > 1) if n else times
        while len(self.shared) and (most is None or len(self.levels) <= most):
            self._double()

    def _double(self) -> None:
        rank, at, step = self.levels[-1], self.shared, 1 << (len(self.levels) - 1)
        after = at + step
        beyond = np.where(after < self.n, rank[np.minimum(after, self.n - 1)], -1)
        key = rank[at].astype(np.int64) * (self.n + 1) + beyond + 1
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        head = rank[at]
        place = np.arange(len(at))
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.ones(len(at), dtype=bool)
        first[1:] = head[1:] != head[:-1]
        group = np.maximum.accumulate(np.where(fresh, place, 0))
        bucket = np.maximum.accumulate(np.where(first, place, 0))
        finer = rank.copy()
        finer[at] = head + group - bucket
        self.levels.append(finer)
        alone = fresh & np.append(fresh[1:], True)
        self.shared = at[~alone]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes from these places on are equal; a and b differ everywhere."""
        off = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + off, b + off
            inside = np.maximum(x, y) < self.n
            rank = self.levels[k]
            same = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
            off += same.astype(np.int64) << k
        return off

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes just before these places are equal."""
        off = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - off - (1 << k), b - off - (1 << k)
            inside = np.minimum(x, y) >= 0
            rank = self.levels[k]
            same = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
            off += same.astype(np.int64) << k
        return off


def _intervals(lcp: np.ndarray, n: int, widest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, left, right): for each border where suffixes agree, its interval of the array.

    ``lcp[k]`` is between the suffixes k - 1 and k; the ends hold -1. Steps of halving length
    over minima of blocks find the nearest smaller value on both sides.
    """
    at = np.flatnonzero(lcp > 0)
    mine = lcp[at]
    least = [lcp]
    while 1 << len(least) <= widest:
        last, half = least[-1], 1 << (len(least) - 1)
        least.append(np.minimum(last[:-half], last[half:]))
    left, right = at.copy(), at + 1
    for k in range(len(least) - 1, -1, -1):
        block, size = least[k], 1 << k
        x = left - size
        left = np.where((x >= 0) & (block[np.maximum(x, 0)] >= mine), x, left)
        inside = right < len(block)
        here = inside & (block[np.where(inside, right, 0)] >= mine)
        right = np.where(here, right + size, right)
    return at, left - 1, right - 1


def squares(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Ranks]:
    """Branching squares (place, period): equal halves after which the next code differs."""
    ranks, n = _Ranks(codes), len(codes)
    none = np.zeros(0, dtype=np.int64)
    if n < 2:
        return none, none, ranks
    isa = ranks.levels[-1].astype(np.int64)
    sa = np.empty(n, dtype=np.int64)
    sa[isa] = np.arange(n)
    lcp = np.full(n + 1, -1, dtype=np.int64)
    lcp[1:n] = ranks.ahead(sa[:-1], sa[1:])
    at, left, right = _intervals(lcp.astype(np.int32), n, int(np.bincount(codes).max()))
    if not len(at):
        return none, none, ranks
    _, one, node = np.unique(left * (n + 1) + right, return_index=True, return_inverse=True)
    lb, rb, depth = left[one], right[one], lcp[at[one]]
    of_border = np.full(n + 1, -1, dtype=np.int64)
    of_border[at] = node
    # Children are intervals and single suffixes; the border with the greater value is the parent's.
    starts = np.concatenate([lb, np.arange(n)])
    sizes = np.concatenate([rb - lb + 1, np.ones(n, dtype=np.int64)])
    ends = starts + sizes
    parent = of_border[np.where(lcp[starts] >= lcp[ends], starts, ends)]
    child = np.flatnonzero(parent >= 0)
    child = child[np.lexsort((sizes[child], parent[child]))]
    last = np.append(parent[child][1:] != parent[child][:-1], True)
    child = child[~last]  # all but the largest of each parent
    found = []
    total = np.cumsum(sizes[child])
    while len(child):
        many = max(1, int(np.searchsorted(total, TOGETHER, side="right")))
        now, child, total = child[:many], child[many:], total[many:] - total[many - 1]
        size, up = sizes[now], parent[now]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        place = sa[np.repeat(starts[now], size) + inner]
        low, high, deep = (np.repeat(x[up], size) for x in (lb, rb, depth))
        for half in (place, place - deep):  # this suffix is the first half, or the second
            other = np.where(half == place, place + deep, half)
            inside = (half >= 0) & (half + deep < n) & (other < n)
            where = isa[np.where(inside, other, 0)]
            inside &= (where >= low) & (where <= high)
            half, period = half[inside], deep[inside]
            after = half + 2 * period
            branches = (after >= n) | (codes[np.minimum(after, n - 1)] != codes[half])
            found.append(half[branches] * (n + 1) + period[branches])
    pairs = np.unique(np.concatenate(found)) if found else none
    return pairs // (n + 1), pairs % (n + 1), ranks


def runs(codes: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period."""
    place, period, ranks = squares(codes)
    if not len(place):
        return np.zeros((0, 3), dtype=np.int64)
    start = place - ranks.behind(place, place + period)
    end = place + 2 * period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    keep &= end - start >= np.maximum(least, 2 * period)
    found = np.column_stack([start, end - start, period])[keep]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _coded(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers, distinct between documents, and where each document begins."""
    codes, base = [], 0
    for words in documents:
        number: dict[bytes, int] = {}
        codes.append(np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64) + base)
        base += len(number)
    starts = np.cumsum([0, *map(len, documents)])
    return (np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64)), starts


def found_in(documents: list[list[bytes]], least: int) -> list[np.ndarray]:
    """The runs of each document."""
    found = [np.zeros((0, 3), dtype=np.int64)] * len(documents)
    long = [k for k, words in enumerate(documents) if len(words) >= least]
    codes, starts = _coded([documents[k] for k in long])
    repeated = np.unique(np.searchsorted(starts, _Ranks(codes, TESTED).shared, side="right") - 1)
    long = [long[k] for k in repeated]
    codes, starts = _coded([documents[k] for k in long])
    rows = runs(codes, least)
    owner = np.searchsorted(starts, rows[:, 0], side="right") - 1
    edges = np.searchsorted(owner, np.arange(len(long) + 1))
    for i, k in enumerate(long):
        mine = rows[edges[i] : edges[i + 1]]
        found[k] = mine - np.array([starts[i], 0, 0])
    return found


def _kept(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """Words outside runs, and those of each run's first period."""
    if not len(rows):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]


def collapsed(docs: DataFrame, *, least: int = 12) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` and ``text``, its words without the repeats.

    A run has ``least`` words or more (at least 7) and at least two periods; it cannot be extended.
    Words of a run after its first period go; the others are joined by one space. Null and empty
    texts have no words, no runs and an empty text. Repeated rows give equal rows, other columns
    are not read. A document is worked on whole, in memory of some hundred bytes a word.
    """
    if least < LEAST:
        raise ValueError(f"least: {LEAST} words or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 250):
            documents = [t.split() for t in texts(batch)]
            rows = found_in(documents, least)
            flat = np.concatenate([*rows, np.zeros((0, 3), dtype=np.int64)])
            parts = [pa.array(flat[:, k]) for k in range(3)]
            spans = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()),
                pa.StructArray.from_arrays(parts, ["start", "length", "period"]),
            )
            left = [b" ".join(_kept(w, r)) for w, r in zip(documents, rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(w) for w in documents], pa.int64()),
                    spans,
                    pa.array(left, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "text"],
            )

    return docs.select(column_or_null(docs, "doc_id", "long"), "text").mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, text string"
    )


def longest(spans: Column) -> Column:
    """The run of greatest length; ties: the smallest start, then period. Null if there is none."""
    keyed = F.transform(spans, lambda r: F.struct(-r["length"], r["start"], r["period"]))
    first = F.array_min(keyed)
    return F.when(
        F.size(spans) > 0,
        F.struct(
            first["start"].alias("start"), (-first["col1"]).alias("length"), first["period"].alias("period")
        ),
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, every tenth document with its words made periodic from some place.

    With h the CRC-32 of the decimal id (of nothing if null) and g = h DIV 10: if h ends in 0, word
    i of n becomes word a + (i - a) % p from a = g % n on, p = 1 + (n - a) DIV (3 + g % 8).
    """
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    h = "crc32(coalesce(CAST(doc_id AS STRING), ''))"
    words = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    chosen = rows.withColumn("w", F.expr(f"CASE WHEN {h} % 10 = 0 THEN {words} END"))
    chosen = chosen.withColumn("g", F.expr(f"{h} DIV 10")).withColumn("n", F.size("w"))
    chosen = chosen.withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    chosen = chosen.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    made = "array_join(transform(sequence(0, n - 1), i -> w[IF(i < a, i, a + (i - a) % p)]), ' ')"
    return chosen.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {made} ELSE text END").alias("text"))
