"""Scoring text with prediction by partial matching over byte contexts, and with word counts.

The model is a trie of byte contexts with the counts of what followed each in the training
documents. The probability of a byte is that in the longest context held, by count; where the byte
was never seen there, an escape (method C: as likely as there are different successors) leads to
the next shorter context, in which the successors already ruled out are excluded. Below the empty
context all symbols not excluded are equally likely.

Every successor of a context was also seen after its shorter ones. So what is excluded in a context
depends on the next longer one alone, and the probability of each byte in each context is a table
computed once. Contexts and bytes form an automaton (state: the longest context held that the text
so far ends in), and a text's code length is a walk over it; many pieces of text walk at once.

The trie is a Spark table and grows with the corpus: every context of the training text is held.
One pass cuts texts into groups and counts in each group the distinct keys, a key being the bytes
before a place and the symbol there. Shorter contexts are keys cut off, so levels are aggregated
from that table and each level's probabilities come from the next shorter one's by a join. Each
group is then joined to the probabilities of its own keys and the counts of its own words, never
to the whole model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import LOWER, column_or_null, kept, sliced, texts, training_side

#: Symbols: the bytes, and the end of a text.
END = 256
SYMBOLS = 257
#: Symbols that one walker takes; texts are cut into so many walkers.
STRIDE = 256
#: Symbols walked over at once.
TOGETHER = 4_000_000
#: Bytes of text whose keys and words are counted together, and those worked on at once.
GROUP = 16_000_000
PIECE = 4_000_000
#: Symbols looked up, and bytes of text cut into words, at once.
SMALL_PIECE = 1_000_000
#: Bits of the symbol in a key and of each byte before it: 0 for none, otherwise the byte and one.
BITS = 9
#: Longest context whose keys are longs.
MOST_ORDER = 6


@dataclass(frozen=True)
class Automaton:
    """Contexts as states. Column 0 of the tables is padding, 1 any symbol never seen."""

    order: int
    column: np.ndarray  # of each symbol
    follow: np.ndarray  # state after (state, column), flattened
    contexts: tuple[tuple[int, ...], ...]  # columns, by state; shorter ones come first
    score: np.ndarray | None = None  # log10 of the probability of (state, column)

    @property
    def width(self) -> int:
        return int(self.column.max()) + 1

    def walk(self, batch: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For groups of walkers: (number of the text, places in the tables by step)."""
        width, lead = self.width, self.order
        for first, flat, starts, owner in _laid_out(batch, self.column, lead):
            steps = np.arange(lead + STRIDE)
            many = max(TOGETHER // STRIDE, 1)
            for k in range(0, len(starts), many):
                symbols = flat[starts[k : k + many] + steps[:, None]]
                state = np.zeros(symbols.shape[1], dtype=np.int32)
                for t in range(lead):
                    state = self.follow[state * width + symbols[t]]
                places = np.empty((STRIDE, symbols.shape[1]), dtype=np.int32)
                for t in range(STRIDE):
                    np.add(state * width, symbols[lead + t], out=places[t])
                    state = self.follow[places[t]]
                yield first + owner[k : k + many], places

    def scores(self, batch: list[bytes]) -> np.ndarray:
        found = np.zeros(len(batch))
        for owner, places in self.walk(batch):
            np.add.at(found, owner, self.score[places].sum(axis=0, dtype=np.float64))
        return found


def _laid_out(batch: list[bytes], column: np.ndarray, lead: int):
    """Texts, each with an end, as columns with padding; where walkers start and whose they are."""
    first = 0
    while first < len(batch):
        parts, starts, owner, at, k = [], [], [], 0, first
        while k < len(batch) and (k == first or at + len(batch[k]) < TOGETHER):
            symbols = np.frombuffer(batch[k], dtype=np.uint8)
            walkers = -(-(len(symbols) + 1) // STRIDE)
            room = np.zeros(lead + walkers * STRIDE, dtype=np.int32)
            room[lead : lead + len(symbols)] = column[symbols]
            room[lead + len(symbols)] = column[END]
            parts.append(room)
            starts.append(at + STRIDE * np.arange(walkers))
            owner.append(np.full(walkers, k - first))
            at += len(room)
            k += 1
        yield first, np.concatenate(parts), np.concatenate(starts), np.concatenate(owner)
        first = k


def _automaton(order: int, column: np.ndarray, contexts: list[tuple[int, ...]]) -> Automaton:
    number = {c: i for i, c in enumerate(contexts)}
    width = int(column.max()) + 1
    follow = np.zeros((len(contexts), width), dtype=np.int32)
    ends = column[END]
    for i, context in enumerate(contexts):  # the shorter context's row is complete by then
        if context:
            follow[i] = follow[number[context[1:]]]
        for c in range(2, width):
            if c != ends and (*context, c) in number:
                follow[i, c] = number[*context, c]
    return Automaton(order, column, follow.ravel(), tuple(contexts))


def train(docs: DataFrame, *, order: int = 4, support: float = 2**-14) -> Automaton:
    """The model of all texts in ``docs``, lower-cased (A-Z), null being empty, in one piece.

    For corpora whose trie fits the driver: level by level, one pass over the text each, contexts
    that make up at least ``support`` of it. :func:`score` does not use it.
    """
    column = np.arange(2, SYMBOLS + 2, dtype=np.int32)
    held = _automaton(0, column, [()])
    counts = _counted(docs, held)
    seen = np.flatnonzero(counts[0, 2:])
    column = np.ones(SYMBOLS, dtype=np.int32)
    column[seen] = np.arange(2, len(seen) + 2)
    counts = counts[:, np.concatenate(([0, 1], seen + 2))]
    contexts: list[tuple[int, ...]] = [()]
    ends = int(column[END])
    if ends < 2:  # no training text at all: every symbol is equally likely
        return _scored(_automaton(0, np.ones(SYMBOLS, dtype=np.int32), [()]), np.zeros((1, 2)))
    held = _automaton(0, column, contexts)
    least = max(support * counts[0].sum(), 1.0)
    for depth in range(1, order + 1):
        longest = range(len(contexts) - sum(len(c) == depth - 1 for c in contexts), len(contexts))
        longer = [
            (*contexts[i], int(c))
            for i in longest
            for c in np.flatnonzero(counts[i] >= least)
            if c > 1 and c != ends
        ]
        if not longer:
            break
        contexts += longer
        held = _automaton(depth, column, contexts)
        counts = _counted(docs, held)
    return _scored(held, counts)


def _counted(docs: DataFrame, automaton: Automaton) -> np.ndarray:
    """How often each column follows each context."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        total = np.zeros(len(held.follow), dtype=np.int64)
        for batch in sliced(batches, 2000):
            for _, places in held.walk([t.translate(LOWER) for t in texts(batch)]):
                total += np.bincount(places.ravel(), minlength=len(total))
        places = np.flatnonzero(total)
        for k in range(0, len(places), 100_000):
            some = places[k : k + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["place", "n"]
            )

    found = docs.select("text").mapInArrow(run, "place long, n long")
    found = found.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(automaton.follow), dtype=np.int64)
    counts[found.column("place").to_numpy()] = found.column("n").to_numpy()
    counts = counts.reshape(-1, automaton.width)
    counts[:, :2] = 0
    number = {c: i for i, c in enumerate(automaton.contexts)}
    for i in range(len(counts) - 1, 0, -1):  # what follows a context follows its shorter ones
        counts[number[automaton.contexts[i][1:]]] += counts[i]
    return counts


def _scored(automaton: Automaton, counts: np.ndarray) -> Automaton:
    """With log10 probabilities, level by level from the empty context."""
    number = {c: i for i, c in enumerate(automaton.contexts)}
    depth = np.array([len(c) for c in automaton.contexts])
    parent = np.array([number[c[1:]] if c else 0 for c in automaton.contexts])
    chance = np.zeros(counts.shape)
    distinct = (counts[0] > 0).sum()
    # ``below``: probability of each column after an escape from the contexts of a level.
    below = np.full((1, counts.shape[1]), 1 / max(SYMBOLS - distinct, 1))
    for level in range(depth.max() + 1):
        here = np.flatnonzero(depth == level)
        count, mine = counts[here], counts[here] > 0
        if level:
            shorter = counts[parent[here]]
            fresh = np.where(mine, 0, shorter)  # what remains there without the excluded
            kinds = (fresh > 0).sum(axis=1, keepdims=True)
            whole = np.maximum(fresh.sum(axis=1, keepdims=True) + kinds, 1)
            escape = np.where(kinds > 0, kinds / whole, 1.0)
            before = below[parent[here] - first]
            below = np.where(fresh > 0, fresh / whole, escape * before)
        first = here[0]
        kinds = mine.sum(axis=1, keepdims=True)
        whole = count.sum(axis=1, keepdims=True) + kinds
        escape = np.where(whole > 0, kinds / np.maximum(whole, 1), 1.0)
        chance[here] = np.where(mine, count / np.maximum(whole, 1), escape * below)
    with np.errstate(divide="ignore"):
        score = np.log10(chance).astype(np.float32)
    score[:, 0] = 0
    return Automaton(
        automaton.order, automaton.column, automaton.follow, automaton.contexts, score.ravel()
    )


def score(
    docs: DataFrame,
    *,
    modulus: int = 5,
    held_out: int = 1,
    order: int = 4,
    support: float = 0.0,
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``.

    Tokens are the lower-cased words and one end per document; ``base_score`` is the sum of their
    smoothed log10 frequencies among the training documents, ``n_known`` how many of them occur
    there. ``score`` is the model's log10 probability of the lower-cased text and its end. Null
    texts are empty, a null id counts as the empty string when sides are dealt, repeated rows are
    documents of their own, and an empty table gives an empty result. Without any training
    document every symbol is as likely as any other. Every context of the training text is held,
    unless ``support`` asks for those alone that make up so much of it.
    """
    if not 0 <= order <= MOST_ORDER:
        raise ValueError(f"the keys are made for contexts of up to {MOST_ORDER} bytes")
    side = training_side(column_or_null(docs, "doc_id", "long"), modulus, held_out)
    rows = docs.select(column_or_null(docs, "doc_id", "long"), side.alias("learn"), "text")
    found = kept(
        rows.mapInArrow(
            lambda batches: _tokens(batches, order),
            "row long, doc_id long, learn boolean, n_tokens long, word string, in_training long, "
            "key long, learnt long, lengths array<int>, bytes binary",
        ),
        "tokens",
    )
    words = found.where("word IS NOT NULL").select("row", "word", "in_training")
    vocabulary = words.groupBy("word").agg(F.sum("in_training").alias("c")).where("c > 0")
    vocabulary = kept(vocabulary, "vocabulary")
    total = vocabulary.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"] or 0, total["v"]
    keys = found.where("key IS NOT NULL").select("row", "key", "learnt")
    chances = _chances(keys, order=order, support=support)
    # Written, so that the shuffle of the join is gone before the one by group.
    model = kept(
        keys.select("row", "key").join(chances.hint("merge"), "key").select(
            "row", "key", F.log10("chance").cast("float").alias("chance"),
            F.lit(None).cast("string").alias("word"), F.lit(None).cast("long").alias("c"),
        ).unionByName(
            words.select("row", "word").join(vocabulary.hint("merge"), "word"), allowMissingColumns=True
        ),
        "ppm-model",
    )
    groups = found.where("lengths IS NOT NULL").select(F.col("row").alias("first"), "lengths", "bytes")
    sums = groups.groupBy("first").cogroup(model.groupBy("row")).applyInArrow(
        lambda left, right: _group_scores(left, right, order, n, v),
        "row long, n_known long, base_score double, score double",
    )
    heads = found.where("n_tokens IS NOT NULL").select("row", "doc_id", "learn", "n_tokens")
    return heads.join(sums, "row").select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _chances(keys: DataFrame, *, order: int, support: float) -> DataFrame:
    """``key`` and ``chance``: the probability of each key's symbol after its context.

    ``keys`` has ``learnt``, how often a key is in training text; keys found elsewhere have 0 and
    get their probability by escapes. Symbols after one context are at most 257 rows.
    """
    counts = kept(keys.groupBy("key").agg(F.sum("learnt").alias("n")), "ppm-keys")
    least = max(support * (counts.agg(F.sum("n")).first()[0] or 0), 1.0)
    inside = Window.partitionBy(F.shiftright("key", BITS))
    levels = []
    for depth in range(order + 1):
        here = counts
        if depth:  # places with so many bytes before them
            here = here.where(F.shiftright("key", BITS * depth).bitwiseAND((1 << BITS) - 1) > 0)
        low = F.col("key").bitwiseAND(F.lit((1 << BITS * (depth + 1)) - 1))
        here = here.groupBy(low.alias("key")).agg(F.sum("n").alias("n"))
        seen = F.col("n") > 0
        if depth:
            before = levels[-1].select(
                F.col("key").alias("shorter"), *[F.col(c).alias(f"{c}_1") for c in levels[-1].columns if c != "key"]
            )
            here = here.withColumn(
                "shorter", F.col("key").bitwiseAND(F.lit((1 << BITS * depth) - 1))
            ).join(before.hint("merge"), "shorter")
            here = here.withColumn("covered", F.sum(F.when(seen, F.col("n_1")).otherwise(0)).over(inside))
        here = here.withColumn("total", F.sum("n").over(inside)).withColumn(
            "kinds", F.sum(seen.cast("long")).over(inside)
        )
        whole = F.greatest(F.col("total") + F.col("kinds"), F.lit(1))
        escape = F.when(F.col("kinds") > 0, F.col("kinds") / whole).otherwise(1.0)
        if depth:  # what remains in the shorter context without the symbols seen in this one
            kinds = F.col("kinds_1") - F.col("kinds")
            rest = F.greatest(F.col("total_1") - F.col("covered") + kinds, F.lit(1))
            on = F.when(kinds > 0, kinds / rest).otherwise(1.0)
            below = F.when(F.col("n_1") > 0, F.col("n_1") / rest).otherwise(on * F.col("below_1"))
        else:
            below = 1 / F.greatest(SYMBOLS - F.col("kinds"), F.lit(1))
        here = here.withColumn("below", below)
        chance = F.when(seen, F.col("n") / whole).otherwise(escape * F.col("below"))
        if depth:
            chance = F.when(F.col("total") < least, F.col("chance_1")).otherwise(chance)
        here = here.withColumn("chance", chance)
        levels.append(kept(here.select("key", "n", "total", "kinds", "below", "chance"), "ppm-level"))
    found = levels[0].select("key", "chance")
    for level in levels[1:]:  # contexts of different lengths have different keys
        found = found.union(level.select("key", "chance"))
    return found


def _keyed(found: list[bytes], order: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For pieces of a group: the number of the text, and the key, of every place."""
    symbols = np.frombuffer(b"".join(t + b"\0" for t in found), dtype=np.uint8).astype(np.int16)
    lengths = np.array([len(t) + 1 for t in found], dtype=np.int64)
    ends = np.cumsum(lengths) - 1
    symbols[ends] = END
    held = np.zeros(order + len(symbols), dtype=np.int16)
    held[order:] = symbols + 1
    held[order + ends] = 0
    owner = np.repeat(np.arange(len(found), dtype=np.int32), lengths)
    for start in range(0, len(symbols), piece):
        key = symbols[start : start + piece].astype(np.int64)
        alive = np.ones(len(key), dtype=bool)
        for k in range(1, order + 1):
            byte = held[order + start - k : order + start - k + len(key)]
            alive &= byte > 0
            key |= (byte * alive).astype(np.int64) << (BITS * k)
        yield owner[start : start + piece], key


def _words(found: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, and for every word its number and its text's."""
    split = pc.ascii_split_whitespace(pa.array(found, pa.binary()).cast(pa.string()))
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(found), dtype=np.int32), np.diff(split.offsets.to_numpy()))
    real = pc.not_equal(coded.dictionary, "")  # what is before the first blank and after the last
    number = (np.cumsum(real.to_numpy(zero_copy_only=False)) - 1).astype(np.int32)
    kept_ones = real.to_numpy(zero_copy_only=False)[code]
    return coded.dictionary.filter(real), number[code[kept_ones]], owner[kept_ones]


class _Places:
    """Where each key is in an array of distinct ones: tables indexed by hash, one after the other for
    those that another key took the place of, so that a look-up is a few gathers and no search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.tables = keys, []
        left = np.arange(len(keys), dtype=np.int32)
        while len(left):
            bits = max(4, (4 * len(left) - 1).bit_length())
            table = np.zeros(1 << bits, dtype=np.int32)
            slot = self._slots(keys[left], len(self.tables), bits)
            table[slot] = left
            self.tables.append(table)
            left = left[table[slot] != left]

    @staticmethod
    def _slots(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
        return (keys.view(np.uint64) * odd) >> np.uint64(64 - bits)

    def of(self, asked: np.ndarray) -> np.ndarray:
        found, open_ones = np.zeros(len(asked), dtype=np.int32), np.arange(len(asked), dtype=np.int32)
        for level, table in enumerate(self.tables):
            some = asked[open_ones]
            here = table[self._slots(some, level, len(table).bit_length() - 1)]
            found[open_ones] = here
            open_ones = open_ones[self.keys[here] != some]
            if not len(open_ones):
                return found
        if len(asked):
            raise KeyError(int(asked[open_ones[0]]))
        return found


def _group(row: int, found: list[bytes], learn: list[bool], order: int) -> Iterator[pa.RecordBatch]:
    """Keys and words of a group of documents, and the documents themselves, packed."""
    side = np.array(learn, dtype=np.int64)
    kinds, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for owner, key in _keyed(found, order):
        key <<= 1
        key |= side[owner]
        some, many = np.unique(key, return_counts=True)
        kinds, at = np.unique(np.concatenate((kinds, some)), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate((times, many))).astype(np.int64)
    starts = np.flatnonzero(np.diff(kinds >> 1, prepend=-1))
    yield _filled(
        len(starts), row=pa.array(np.full(len(starts), row)), key=pa.array(kinds[starts] >> 1),
        learnt=pa.array(np.add.reduceat(times * (kinds & 1), starts), pa.int64()),
    )
    words, code, owner = _words(found)
    used = pa.concat_arrays([words, pa.array([""])])
    in_training = np.append(np.bincount(code[side[owner] > 0], minlength=len(words)), sum(learn))
    yield _filled(
        len(used), row=pa.array(np.full(len(used), row)), word=used, in_training=pa.array(in_training, pa.int64())
    )
    packed = zstandard.ZstdCompressor(level=1).compress(b"".join(found))
    yield _filled(
        1, row=pa.array([row], pa.int64()), bytes=pa.array([packed], pa.binary()),
        lengths=pa.array([[len(t) for t in found]], pa.list_(pa.int32())),
    )


def _group_scores(group: pa.Table, model: pa.Table, order: int, n: int, v: int) -> pa.Table:
    """Scores of a group's documents; ``model`` has its keys and those of its words that are known."""
    row, lengths = group.column("first")[0].as_py(), group.column("lengths")[0].as_py()
    whole = zstandard.ZstdDecompressor().decompress(group.column("bytes")[0].as_py())
    ends = np.cumsum([0, *lengths])
    found = [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    known = model.filter(pc.is_valid(model.column("word"))).combine_chunks()
    base, n_known = np.zeros(len(found)), np.zeros(len(found), dtype=np.int64)
    cuts = np.searchsorted(ends, np.arange(0, ends[-1] + SMALL_PIECE, SMALL_PIECE))
    for first, beyond in pairwise(np.unique([0, *cuts, len(found)]).tolist()):
        some = found[first:beyond]
        words, code, owner = _words(some)
        asked = pa.concat_arrays([words, pa.array([""])])  # the end comes last
        at = pc.index_in(asked, value_set=known.column("word"))
        c = pc.fill_null(known.column("c").take(at), 0).to_numpy().astype(np.float64)
        logs = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        base[first:beyond] = np.bincount(owner, weights=logs[code], minlength=len(some)) + logs[-1]
        n_known[first:beyond] = np.bincount(owner, weights=(c > 0)[code], minlength=len(some)) + (c[-1] > 0)
    model = model.filter(pc.is_valid(model.column("key")))
    place = _Places(model.column("key").to_numpy())
    chance = model.column("chance").to_numpy().astype(np.float64)
    scores = np.zeros(len(found))
    for owner, key in _keyed(found, order, SMALL_PIECE):
        scores += np.bincount(owner, weights=chance[place.of(key)], minlength=len(found))
    return pa.table(
        {"row": np.arange(row, row + len(found)), "n_known": n_known, "base_score": base, "score": scores}
    )


def _tokens(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and for each group of documents a row per key and word, and the texts.

    ``row`` numbers documents, and in the other rows it is the group's first one. The end of a text
    is the empty word.
    """
    row = first = TaskContext.get().partitionId() << 40
    waiting: list[bytes] = []
    sides: list[bool] = []
    size = 0
    for batch in sliced(batches, 1000):
        lowered = [t.translate(LOWER) for t in texts(batch)]
        many = batch.num_rows
        yield _filled(
            many, row=pa.array(np.arange(row, row + many)), doc_id=batch.column("doc_id"),
            learn=batch.column("learn"),
            n_tokens=pa.array([len(t.split()) + 1 for t in lowered], pa.int64()),
        )
        row += many
        for text, side in zip(lowered, batch.column("learn").to_pylist(), strict=True):
            if waiting and size + len(text) > GROUP:
                yield from _group(first, waiting, sides, order)
                first, waiting, sides, size = first + len(waiting), [], [], 0
            waiting.append(text)
            sides.append(side)
            size += len(text) + 1
    if waiting:
        yield from _group(first, waiting, sides, order)


def _filled(many: int, **columns: pa.Array) -> pa.RecordBatch:
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()),
        ("n_tokens", pa.int64()), ("word", pa.string()),
        ("in_training", pa.int64()), ("key", pa.int64()), ("learnt", pa.int64()),
        ("lengths", pa.list_(pa.int32())), ("bytes", pa.binary()),
    ])
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(many, f.type)) for f in schema], schema=schema
    )
