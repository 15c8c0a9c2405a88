"""Packing documents into sequences of a fixed number of tokens.

Documents become pieces of at most one sequence's length, and how many pieces there are of each
length says all that packing needs: a table of as many rows as a sequence has tokens, however large
the corpus. From it a plan is made in four steps:

1. Linear grouping: large pieces, sorted, are cut into groups of equally many, and each length is
   rounded up to the largest of its group.
2. With so few sizes, the best mix of configurations (which sizes share a sequence) is a linear
   programme; its columns are generated by a knapsack.
3. Actual lengths take the places of the rounded ones.
4. Best fit: what is left, from long to short, goes where least room remains.

The plan is a list of places: "pieces number i to k of this length go to sequences s, s + 1, ...".
Spark numbers the pieces of each length and joins them to their places.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from functools import cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import column_or_null, kept

#: Parts of words whose tokens a Python worker remembers.
REMEMBERED = 300_000
#: Bytes of text that a Python worker tokenises together.
AT_ONCE = 1 << 21
#: Bytes of words that the tokenizer gets in one call.
IN_A_CALL = 1 << 17
#: Letters of Latin-1, which normalisation leaves alone but for their case.
LETTERS = r"[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]"
#: ASCII characters that are neither letters nor digits nor white space.
MARKS = r"[!-/:-@\[-`{-~]"
#: Pieces above this part of a sequence count as large.
LARGE = 1 / 8
#: Numbers of groups tried; the plan with the fewest sequences is taken.
GROUPS = (8, 16, 32)
#: Pieces of one length are numbered in so many parts, so that no window holds them all.
PARTS = 1024


def _splits_at_blanks(path: str) -> bool:
    """Whether the file describes what ``_Tokens`` relies on: small letters, no pre-token across
    white space, letters apart from marks, characters of bytes for the model."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    normal = spec.get("normalizer") or {}
    steps = [n.get("type") for n in normal.get("normalizers", [normal])]
    before = spec.get("pre_tokenizer") or {}
    cuts = before.get("pretokenizers", [])
    return (
        spec["model"].get("type") == "BPE"
        and steps == ["NFC", "Replace", "Lowercase"]
        and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0].get("invert") is True
        and "[\\p{L}]+" in cuts[0]["pattern"].get("Regex", "")
        and cuts[1].get("use_regex") is False
        and cuts[1].get("add_prefix_space") is False
    )


class _Tokens:
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    No pre-token crosses ASCII white space, so a text's ids are those of its words in a row. Words
    of Latin-1 letters are one pre-token and ASCII marks behind them another. Each distinct one of
    a batch is looked up once; new ones go to the tokenizer many in a call, those of letters to one
    with the same model that only cuts at blanks. A tokenizer that is made otherwise gets whole
    texts.
    """

    def __init__(self, path: str) -> None:
        # Spark gives a task one core: the tokenizer starts no threads of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = _splits_at_blanks(path)
        self.of_model = Tokenizer(self.tokenizer.model)
        self.of_model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        as_characters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: What the model reads for each byte of a letter; blanks stay.
        self.characters = np.arange(256, dtype="<u4")
        for c in range(0x80, 0x100):
            for byte, read in zip(chr(c).encode(), as_characters.pre_tokenize_str(chr(c))[0][0], strict=True):
                self.characters[byte] = ord(read)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        #: Whether a token ends a word.
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # Remembered parts of words, their ids in a row, the numbers of ids, the batch last used in.
        self.parts = pa.array([], pa.string())
        self.ids = np.empty(0, dtype="<u4")
        self.sizes = np.empty(0, dtype=np.int64)
        self.used = np.empty(0, dtype=np.int64)

    def of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, the number of ids of each part there, and where each of ``parts`` is."""
        at = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy().astype(np.int64)
        new = at < 0
        at[new] = len(self.parts) + np.arange(new.sum())
        more = parts.filter(pa.array(new))
        ids, sizes = self._of_new(more)
        known = pa.concat_arrays([self.parts, more])
        ids, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        used = np.append(self.used, np.zeros(len(more), dtype=np.int64))
        used[at] = self.used.max(initial=0) + 1
        self._remember(known, ids, sizes, used)
        return ids, sizes, at

    def _remember(self, known: pa.Array, ids: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> None:
        """All but long parts; of too many, the half that was used last."""
        keep = pc.binary_length(known).to_numpy() <= 64
        if len(known) > REMEMBERED:
            late = np.zeros(len(known), dtype=bool)
            late[np.argsort(-used, kind="stable")[: REMEMBERED // 2]] = True
            keep &= late
        if not keep.all():
            ids, _ = _gathered(ids, sizes, np.flatnonzero(keep))
            known, sizes, used = known.filter(pa.array(keep)), sizes[keep], used[keep]
        self.parts, self.ids, self.sizes, self.used = known, ids, sizes, used

    def _of_new(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has."""
        if not len(parts):
            return self.ids[:0], self.sizes[:0]
        plain = pc.match_substring_regex(parts, f"^{LETTERS}+$").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        found = []
        for mask, method in ((plain, self._of_letters), (~plain, self._of_others)):
            some = parts.filter(pa.array(mask))
            for first, beyond in pairwise(_edges(pc.binary_length(some).to_numpy(), IN_A_CALL)):
                found.append(method(some.slice(first, beyond - first)))
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return _gathered(ids, sizes, back)[0], sizes[back]

    def _of_letters(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of small Latin-1 letters, which need no normalisation."""
        in_one = pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts)
        (joined,) = pc.binary_join(in_one, " ")
        coded = np.frombuffer(joined.as_buffer(), dtype=np.uint8)
        text = self.characters[coded].tobytes().decode("utf-32-le")
        (found,) = self.of_model.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts) or ends[-1] != len(ids):  # a model without a token for some end
            return self._of_others(parts)
        return ids, np.diff(ends, prepend=0)

    def _of_others(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        coded = self.tokenizer.encode(parts.to_pylist(), is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(coded.word_ids, dtype=np.int64), minlength=len(parts))
        return np.array(coded.ids, dtype="<u4"), sizes

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one more: where the last ends)."""
        found = pc.fill_null(column.cast(pa.string()), "")
        if not self.by_words:
            each = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in found.to_pylist()]
            flat = np.fromiter((i for ids in each for i in ids), dtype="<u4")
            return flat, np.cumsum([0, *map(len, each)])
        if not pc.any(pc.match_substring(found, "<|")).as_py():  # capitals could make a special token
            found = pc.ascii_lower(found)
        words = pc.ascii_split_whitespace(found)
        coded = words.flatten().dictionary_encode()
        # Distinct words are letters and marks behind them, or something else and nothing.
        cut = pc.extract_regex(coded.dictionary, f"^(?P<head>{LETTERS}+)(?P<tail>{MARKS}*)$")
        heads = pc.if_else(cut.is_valid(), pc.utf8_lower(pc.struct_field(cut, "head")), coded.dictionary)
        tails = pc.if_else(cut.is_valid(), pc.struct_field(cut, "tail"), "")
        parts = pa.concat_arrays([heads, tails]).dictionary_encode()
        ids, sizes, at = self.of_parts(parts.dictionary)
        both = at[parts.indices.to_numpy()].reshape(2, -1).T
        ids, _ = _gathered(ids, sizes, both.ravel())
        flat, ends = _gathered(ids, sizes[both].sum(axis=1), coded.indices.to_numpy())
        offsets = words.offsets.to_numpy()
        return flat, np.append(0, ends)[offsets - offsets[0]]


def _gathered(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches of so many ids each, those at ``at`` in a row, and where each of them ends."""
    here = sizes[at]
    ends = np.cumsum(here)
    place = np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - here), here)
    place += np.arange(len(place))
    return ids[place], ends


def _edges(sizes: np.ndarray, most: int) -> list[int]:
    """Where to cut a row of such sizes into stretches of about ``most``, or one that is larger."""
    part = np.cumsum(sizes, dtype=np.int64) // most
    return [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)] if len(sizes) else [0]


@cache
def _tokens(path: str) -> _Tokens:
    return _Tokens(path)


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``AT_ONCE`` bytes of text, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for first, beyond in pairwise(_edges(sizes, AT_ONCE)):
            yield batch.slice(first, beyond - first)


def _cut(
    batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, end: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    tokens, last, step = _tokens(tokenizer), np.array([end], dtype="<u4").tobytes(), 4 * capacity
    for batch in _by_size(batches):
        from_doc, piece, start, length, crc, ids = [], [], [], [], [], []
        flat, edges = tokens.of(batch.column("text"))
        for i, (first, beyond) in enumerate(pairwise(edges.tolist())):
            whole = flat[first:beyond].tobytes() + last
            for k, at in enumerate(range(0, len(whole), step)):
                part = whole[at : at + step]
                from_doc.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(from_doc, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(ids if with_ids else [None] * len(piece), pa.list_(pa.int32())),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
        )


def pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end: int = 1, with_ids: bool = False
) -> DataFrame:
    """Documents as token ids and an end id, cut where longer than a sequence. Null is empty."""
    run = partial(_cut, tokenizer=tokenizer, capacity=capacity, end=end, with_ids=with_ids)
    return docs.select(column_or_null(docs, "doc_id", "long"), "text").mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>",
    )


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end: int = 1, with_ids: bool = False
) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, if wanted, ``ids``. Offsets in a sequence leave no gap.

    Each row of ``docs`` is a document of its own, also where ids repeat or are null. An empty
    table gives no pieces.
    """
    cut = kept(pieces(docs, tokenizer, capacity=capacity, end=end, with_ids=with_ids), "pieces")
    lengths = cut.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in lengths.collect()}  # at most ``capacity`` rows
    places = cut.sparkSession.createDataFrame(
        plan(counts, capacity),
        "length long, first long, beyond long, sequence long, each long, at long",
    )
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS))
    order = ["doc_id", "piece", "ids_crc32", "start"]
    inside = Window.partitionBy("length", "part").orderBy(*order)
    earlier = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = cut.withColumn("part", part)
    passed = cut.groupBy("length", "part").agg(F.count("*").alias("here"))
    passed = passed.select(
        "length", "part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("passed")
    )
    numbered = cut.withColumn("local", F.row_number().over(inside) - 1)
    numbered = numbered.join(passed, ["length", "part"]).withColumn("nth", F.expr("local + passed"))
    # Broadcast: the places depend on the distinct lengths, which the capacity bounds.
    found = numbered.join(F.broadcast(places), "length").where("nth >= first AND nth < beyond")
    found = found.withColumn("i", F.expr("nth - first"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return found.select(
        *columns,
        F.expr("sequence + i DIV each").alias("sequence_id"),
        F.expr("at + i % each * length").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: ``sequence_id``, ``ids``, ``doc_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places (length, first, beyond, sequence, each, at) for so many pieces of each length.

    Pieces ``first`` to ``beyond`` of a length go, ``each`` to a sequence, to ``sequence`` and
    those after it, from offset ``at``.
    """
    best = None
    for groups in GROUPS:
        blocks = _blocks(counts, capacity, groups)
        if best is None or sum(b.bins for b in blocks) < sum(b.bins for b in best):
            best = blocks
    places, used, sequence = [], dict.fromkeys(counts, 0), 0
    for block in best:
        at = 0
        for length, each in block.holds:
            first = used[length]
            used[length] = beyond = first + block.bins * each
            places.append((length, first, beyond, sequence, each, at))
            at += length * each
        sequence += block.bins
    return places


class _Block:
    """Sequences filled alike: how many, and the lengths in each with their numbers."""

    __slots__ = ("bins", "holds")

    def __init__(self, bins: int, holds: list[tuple[int, int]]) -> None:
        self.bins = bins
        self.holds = holds

    def room(self, capacity: int) -> int:
        return capacity - sum(length * each for length, each in self.holds)


def _blocks(counts: dict[int, int], capacity: int, groups: int) -> list[_Block]:
    left = {length: n for length, n in counts.items() if n}
    blocks = [_Block(left.pop(capacity), [(capacity, 1)])] if capacity in left else []
    queues = _grouped({x: n for x, n in left.items() if x > capacity * LARGE}, groups)
    sizes = sorted(queues, reverse=True)
    demand = [sum(n for _, n in queues[s]) for s in sizes]
    for bins, configuration in _configurations(sizes, demand, capacity):
        wanted = [(queues[s], a) for s, a in zip(sizes, configuration, strict=True) if a]
        blocks += _substituted(wanted, bins)
    small = {x: n for x, n in left.items() if x <= capacity * LARGE}
    for queue in queues.values():
        for length, n in queue:
            small[length] = small.get(length, 0) + n
    return _best_fit(blocks, small, capacity)


def _grouped(large: dict[int, int], groups: int) -> dict[int, deque]:
    """Rounded size to the actual lengths, from long to short, with their numbers.

    No more lengths than groups: nothing to round.
    """
    if len(large) <= groups:
        return {length: deque([(length, n)]) for length, n in large.items()}
    total = sum(large.values())
    per_group = -(-total // groups) if total else 1
    found: dict[int, deque] = {}
    size, free = 0, 0
    for length in sorted(large, reverse=True):
        n = large[length]
        while n:
            if not free:
                size, free = length, per_group
                found.setdefault(size, deque())
            here = min(n, free)
            found[size].append((length, here))
            n, free = n - here, free - here
    return found


def _configurations(sizes: list[int], demand: list[int], capacity: int):
    """Whole numbers of sequences for each configuration; at most the demand is covered.

    The linear programme (fewest sequences that cover the demand) by the simplex method; a new
    configuration is the best knapsack under the present prices of the sizes.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    need = np.array(demand, dtype=float)
    for _ in range(50 * k):
        prices = np.linalg.solve(basis.T, np.ones(k))
        column, worth = _knapsack(sizes, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        into, now = np.linalg.solve(basis, column), np.linalg.solve(basis, need)
        ratios = np.where(into > 1e-9, now / np.where(into > 1e-9, into, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    found, rest = [], list(demand)
    for x, column in zip(np.linalg.solve(basis, need), basis.T, strict=True):
        configuration = [int(round(a)) for a in column]
        most = min((r // a for r, a in zip(rest, configuration, strict=True) if a), default=0)
        bins = min(int(max(x, 0) + 1e-6), most)
        if bins:
            rest = [r - a * bins for r, a in zip(rest, configuration, strict=True)]
            found.append((bins, configuration))
    return found


def _knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Most valuable numbers of each size that fit, by depth-first search with a bound."""
    order = sorted(range(len(sizes)), key=lambda i: -prices[i] / sizes[i])
    worth = [float(prices[i]) for i in order]
    size = [sizes[i] for i in order]
    best, best_value = [], 1.0 + 1e-9
    stack = [(0, capacity, 0.0, ())]
    while stack:
        i, room, value, taken = stack.pop()
        if value > best_value:
            best_value, best = value, taken
        while i < len(size) and size[i] > room:
            i += 1
        if i == len(size) or worth[i] <= 0 or value + room * worth[i] / size[i] <= best_value:
            continue
        for n in range(room // size[i] + 1):  # the largest number is looked at first
            more = (*taken, (order[i], n)) if n else taken
            stack.append((i + 1, room - n * size[i], value + n * worth[i], more))
    column = np.zeros(len(sizes))
    for i, n in best:
        column[i] += n
    return column, best_value


def _substituted(wanted: list[tuple[deque, int]], bins: int) -> list[_Block]:
    """Sequences of one configuration, with actual lengths in place of the rounded ones."""
    found = []
    while bins:
        alike = min(bins, *(queue[0][1] // a for queue, a in wanted))
        holds = []
        for queue, a in wanted:
            need = a * max(alike, 1)
            while need:
                length, n = queue.popleft()
                here = min(n, need)
                need -= here
                if n > here:
                    queue.appendleft((length, n - here))
                holds.append((length, here if not alike else a))
        found.append(_Block(max(alike, 1), holds))
        bins -= max(alike, 1)
    return found


def _best_fit(blocks: list[_Block], rest: dict[int, int], capacity: int) -> list[_Block]:
    """The rest from long to short, each where the least room that is enough remains."""
    by_room: dict[int, list[_Block]] = {}
    rooms: list[int] = []
    done = []

    def add(block: _Block) -> None:
        room = block.room(capacity)
        if not room:
            done.append(block)
        elif room in by_room:
            by_room[room].append(block)
        else:
            by_room[room] = [block]
            insort(rooms, room)

    for block in blocks:
        add(block)
    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                per = capacity // length
                if n >= per:
                    add(_Block(n // per, [(length, per)]))
                if n % per:
                    add(_Block(1, [(length, n % per)]))
                break
            room = rooms[k]
            block = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[k]
            per = room // length
            full, over = min(block.bins, n // per), 0
            if full < block.bins and n - full * per:
                over = n - full * per
            if full:
                add(_Block(full, [*block.holds, (length, per)]))
            if over:
                add(_Block(1, [*block.holds, (length, over)]))
            same = block.bins - full - bool(over)
            if same:
                add(_Block(same, block.holds))
            n -= full * per + over
    return done + [b for same in by_room.values() for b in same]
