"""Repair of conversations at least cost: auction shortest paths over a lattice of edits.

A node of the lattice is a place between two rows and what the kept roles end in: nothing, a system
message, a user or an assistant. Arcs keep, re-role or delete the next row, or insert an empty
message; their costs are whole numbers. The auction keeps one path from the origin and a price at
each node that never exceeds an arc's cost plus the price at its end. It extends the path along the
arc that attains this, or else raises the price of its last node and takes it off the path. When
the path reaches the end, prices are dual optimal: an arc is on a cheapest path if it is tight
(price = cost + price at its end) and leads to the end by tight arcs. Of those the least letter is
taken at every node, so that the edits' initials are the least of all cheapest ones.

Conversations may be long, one may hold a third of all rows. Rows are dealt in order, by ranges, to
parts; a conversation's rows are blocks of a bounded number. Costs between the four states at both
ends of a block, also from auctions, are chained over the blocks of a conversation from its end, which
gives each block the prices behind it; then every block is traced from each state it may begin in, on
its own, and what each conversation goes through is read off the blocks' ends. Only hashing the
repaired text in order is one task for each conversation; it reads rows as they come and holds none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import Scratch, column_or_null, kept

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: What the kept roles end in.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Costs and edits after the last row: an unanswered user is answered, a lone system message led on.
END_PRICES = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
#: Rows of one block (as a power of two), and of one auction.
BLOCK_BITS = 12
AUCTION = 32
_FAR = 1 << 60
_KEEPS = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_NEXT = (USER, USER, ASSISTANT, USER)


class Lattice:
    """Some rows, the price of each state behind them, and the prices of an auction on them.

    A row is (symbol, copies): the initial of its role (``o`` for any but s, u, a), a capital if it
    is truncated, ``x`` if it must go; its further copies must go. Node ``4 * i + state`` stands
    before row i. Prices begin at what every path pays.
    """

    def __init__(self, rows: list[tuple[str, int]], behind: tuple[int, ...]) -> None:
        self.rows = rows
        self.end = 4 * len(rows) + 4
        self.behind = behind
        self.base = min(behind)
        self.prices = [0] * (self.end + 1)
        least = 0
        for i in range(len(rows) - 1, -1, -1):
            symbol, copies = rows[i]
            least += DELETE * (copies - 1) + (DELETE if symbol == "x" else TRUNCATED * symbol.isupper())
            self.prices[4 * i : 4 * i + 4] = [least] * 4
        self.known: dict[int, list[tuple[str, int, int]]] = {}

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, cost, node it leads to), by letter."""
        found = self.known.get(node)
        if found is not None:
            return found
        i, state = divmod(node, 4)
        if i == len(self.rows):
            price = self.behind[state] - self.base
            found = [("", price, self.end)] if price < _FAR >> 1 else []
        else:
            symbol, copies = self.rows[i]
            more, step = DELETE * (copies - 1), 4 * i + 4
            found = [("D", DELETE + more, step + state), ("I", INSERT, 4 * i + _NEXT[state])]
            if symbol != "x":
                more += TRUNCATED * symbol.isupper()
                kept = _KEEPS.get((symbol.lower(), state))
                if kept is not None:
                    found.append(("K", more, step + kept))
                found.append(("R", REROLE + more, step + _NEXT[state]))
        self.known[node] = found
        return found

    def auction(self, origin: int) -> int:
        """The cheapest way from a state before the first row to the end; prices then prove it."""
        prices, path = self.prices, [origin]
        while path[-1] != self.end:
            node = path[-1]
            best, to = _FAR, -1
            for _, cost, head in self.arcs(node):
                if cost + prices[head] < best:
                    best, to = cost + prices[head], head
            if prices[node] < best:  # contract
                prices[node] = best
                if node != origin:
                    path.pop()
                elif best >= _FAR:
                    return _FAR
            else:
                path.append(to)  # extend
        return prices[origin] + self.base

    def tight(self, node: int) -> list[tuple[str, int, int]]:
        prices = self.prices
        return [a for a in self.arcs(node) if prices[node] == a[1] + prices[a[2]] < _FAR]

    def trace(self, origin: int) -> tuple[list[str], int]:
        """Edits of each row, the least of all cheapest ones, and the state behind the rows."""
        self.auction(origin)
        leads = [False] * self.end + [True]
        for i in range(len(self.rows), -1, -1):
            # Inserting leads from a state to one that is looked at before or in the second turn.
            for state in (USER, ASSISTANT, USER, ASSISTANT, SYSTEM, NOTHING):
                node = 4 * i + state
                leads[node] = any(leads[head] for _, _, head in self.tight(node))
        node, edits, here = origin, [], ""
        while node < 4 * len(self.rows):
            letter, _, head = next(a for a in self.tight(node) if leads[a[2]])
            here += letter
            if head >= 4 * (node // 4) + 4:
                edits.append(here + "D" * (self.rows[node // 4][1] - 1))
                here = ""
            node = head
        return edits, node % 4


def _pieces(rows: list[tuple[str, int]]) -> list[list[tuple[str, int]]]:
    return [rows[k : k + AUCTION] for k in range(0, len(rows), AUCTION)]


def costs(rows: list[tuple[str, int]]) -> list[list[int]]:
    """Least costs from each state before the rows to each state behind them."""
    total = None
    for piece in _pieces(rows):
        here = [[_FAR] * 4 for _ in range(4)]
        for last in (USER, ASSISTANT):
            lattice = Lattice(piece, tuple(0 if state == last else _FAR for state in range(4)))
            for first in range(4):
                here[first][last] = lattice.auction(first)
        for first, last in ((NOTHING, NOTHING), (NOTHING, SYSTEM), (SYSTEM, SYSTEM)):
            here[first][last] = _without_turns(piece, first, last)
        total = here if total is None else _chained(total, here)
    return total


def _without_turns(rows: list[tuple[str, int]], first: int, last: int) -> int:
    """From nothing or a system message to the same: all rows go, but for one system message kept."""
    gone = sum(DELETE * copies for _, copies in rows)
    if first == last:
        return gone
    return min((gone - DELETE + TRUNCATED * (s == "S") for s, _ in rows if s in "sS"), default=_FAR)


def _chained(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(min(a[i][k] + b[k][j] for k in range(4)), _FAR) for j in range(4)] for i in range(4)]


def _before(here: list[list[int]], behind) -> tuple[int, ...]:
    return tuple(min(here[i][k] + behind[k] for k in range(4)) for i in range(4))


def traced(rows: list[tuple[str, int]], behind, starts=range(4)) -> list[tuple[int, int, list[str]]]:
    """For each state before the rows: least cost, state behind the rows, edits of each row."""
    pieces = _pieces(rows)
    lattices: list[Lattice] = []
    for piece in reversed(pieces):
        lattices.append(Lattice(piece, tuple(behind)))
        if len(lattices) < len(pieces):
            behind = tuple(lattices[-1].auction(state) for state in range(4))
    found = []
    for first in starts:
        state, edits, cost = first, [], None
        for lattice in reversed(lattices):
            if cost is None:
                cost = lattice.auction(first)
            more, state = lattice.trace(state)
            edits += more
        found.append((cost, state, edits))
    return found


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with the faults that a hash of the row's place plants.

    By CRC-32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties it, 2 removes ``.!?``, 3 repeats
    it, 4 makes it a user's. A null role, text, id or turn counts as one blank; ids stay null.
    """
    rows = _columns(rows)
    place = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    rows = rows.withColumn("h", F.expr(f"crc32({place}) % 20")).where("h <> 0")
    rows = rows.select(
        "conv_id",
        "turn",
        F.expr("IF(h = 4, 'user', role)").alias("role"),
        F.expr("CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END").alias("text"),
        F.expr("explode(sequence(1, IF(h = 3, 2, 1)))").alias("copy"),
    )
    return rows.drop("copy")


def _columns(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        column_or_null(rows, "conv_id", "long"),
        column_or_null(rows, "turn", "long"),
        F.coalesce(column_or_null(rows, "role", "string"), blank).alias("role"),
        F.coalesce(column_or_null(rows, "text", "string"), blank).alias("text"),
    )


def in_order(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rows with ``n`` copies, ``place`` in the order of conversation, turn (nulls first), role
    and text, ``symbol`` and fault.

    Equal rows are counted before anything else. ``place`` comes from ranges of the order, so rows of
    one conversation need not be in one task. A row's first sayer is the least turn for its role and
    text; a row of that turn is the first, its copies and later rows are duplicates.
    """
    said = rows.withColumn("said", F.md5(F.encode("text", "UTF-8")))
    counted = scratch.keep(said.groupBy("conv_id", "turn", "role", "text", "said").agg(F.count("*").alias("n")))
    dated = F.struct(F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = scratch.keep(counted.groupBy("conv_id", "role", "said").agg(F.min(dated).alias("first")))
    other = firsts.select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("said").alias("s"), "first"
    )
    same = F.expr("conv_id <=> c AND role = r AND said = s")
    flagged = counted.join(other.hint("merge"), same).withColumn("later", dated != F.col("first"))
    bare = r"rtrim(concat(' ', char(9), char(10), char(11), char(12), char(13)), text)"
    flagged = flagged.withColumn("end", F.expr(f"right({bare}, 1)"))
    flagged = flagged.withColumn(
        "fault",
        F.expr(
            "CASE WHEN end = '' THEN 'blank' WHEN later THEN 'duplicate' "
            "WHEN end NOT IN ('.', '!', '?') THEN 'truncated' END"
        ),
    )
    flagged = flagged.withColumn("initial", F.left("role", F.lit(1)))
    known = "IF(initial IN ('s', 'u', 'a'), initial, 'o')"
    flagged = flagged.withColumn(
        "symbol",
        F.expr(
            f"CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' "
            f"WHEN fault = 'truncated' THEN upper({known}) ELSE {known} END"
        ),
    )
    order = ["conv_id", "turn", "role", "text"]
    ordered = flagged.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.monotonically_increasing_id().alias("place"),
        "turn",
        "role",
        F.expr("IF(symbol = 'x', NULL, text)").alias("text"),
        "n",
        "initial",
        "symbol",
        "fault",
    )
    placed = scratch.keep(ordered)
    scratch.drop(counted)
    return placed


def _parsed(symbols: str) -> list[tuple[str, int]]:
    return [(s, int(n or 1)) for s, n in re.findall(r"([a-zA-Z])(\d*)", symbols)]


def _costed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = [sum(costs(_parsed(s)), []) for s in batch.column("symbols").to_pylist()]
        columns = [batch.column("conv_id"), batch.column("block"), pa.array(flat, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "costs"])


def _priced(group: pd.DataFrame) -> pd.DataFrame:
    """Prices behind each block of a conversation, from its end."""
    group = group.sort_values("block", ascending=False)
    behind, found = END_PRICES, []
    for flat in group["costs"]:
        found.append([int(x) for x in behind])
        behind = _before([list(flat[k : k + 4]) for k in range(0, 16, 4)], behind)
    return pd.DataFrame({"conv_id": group["conv_id"], "block": group["block"], "behind": found})


def _traced_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and state before it: the state behind it, and the edits of its rows."""
    for batch in batches:
        ends, edits = [], []
        for symbols, behind, only, last in zip(
            *(batch.column(c).to_pylist() for c in ("symbols", "behind", "only", "last")), strict=True
        ):
            ways = traced(_parsed(symbols), behind, (NOTHING,) if only else range(4))
            ends.append([state for _, state, _ in ways])
            edits.append([" ".join(way) + (END_EDITS[state] if last else "") for _, state, way in ways])
        columns = [
            batch.column("conv_id"),
            batch.column("block"),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array(edits, pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "ends", "edits"])


def _entered(group: pd.DataFrame) -> pd.DataFrame:
    """The state each block of a conversation begins in."""
    group = group.sort_values("block")
    state, found = NOTHING, []
    for ends in group["ends"]:
        found.append(state)
        state = int(ends[state])
    return pd.DataFrame({"conv_id": group["conv_id"], "block": group["block"], "entry": found})


def edits(placed: DataFrame, scratch: Scratch, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``conv_id``, ``block`` and ``edits`` of its rows, divided by blanks: the least of the cheapest."""
    block = F.shiftright("place", block_bits).alias("block")
    row = F.struct("place", F.expr("concat(symbol, IF(n > 1, CAST(n AS STRING), ''))").alias("symbol"))
    blocks = placed.groupBy("conv_id", block).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    blocks = scratch.keep(blocks.select("conv_id", "block", F.array_join("rows.symbol", "").alias("symbols")))
    ends = blocks.groupBy(F.col("conv_id").alias("c")).agg(
        F.min("block").alias("first_block"), F.max("block").alias("last_block")
    )
    blocks = blocks.join(ends.hint("merge"), F.expr("conv_id <=> c")).drop("c")
    blocks = blocks.withColumn("last", F.expr("block = last_block"))
    short = blocks.where("first_block = last_block")
    short = short.withColumn("behind", F.lit(list(END_PRICES)).cast("array<long>")).withColumn("only", F.lit(True))
    # Conversations of several blocks: a row of 16 numbers for some thousand rows, grouped by conversation.
    long = scratch.keep(blocks.where("first_block < last_block"))
    costed = long.mapInArrow(_costed, "conv_id long, block long, costs array<long>")
    priced = costed.groupBy("conv_id").applyInPandas(_priced, "conv_id long, block long, behind array<long>")
    priced = priced.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "behind")
    long = long.join(priced.hint("merge"), F.expr("conv_id <=> c AND block = b")).withColumn("only", F.lit(False))
    columns = ["conv_id", "block", "symbols", "behind", "only", "last"]
    schema = "conv_id long, block long, ends array<int>, edits array<string>"
    ways = scratch.keep(long.select(*columns).mapInArrow(_traced_blocks, schema))
    entries = ways.select("conv_id", "block", "ends").groupBy("conv_id")
    entries = entries.applyInPandas(_entered, "conv_id long, block long, entry int")
    entries = entries.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "entry")
    chosen = ways.join(entries.hint("merge"), F.expr("conv_id <=> c AND block = b"))
    chosen = chosen.select("conv_id", "block", F.expr("edits[entry]").alias("edits"))
    easy = short.select(*columns).mapInArrow(_traced_blocks, schema)
    return easy.select("conv_id", "block", F.expr("edits[0]").alias("edits")).union(chosen)


class _Repaired:
    """What is known of one conversation while its rows pass by."""

    def __init__(self) -> None:
        self.hash = hashlib.sha256()
        self.state, self.before = NOTHING, None
        self.audit: list[str] = []
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = self.messages = 0
        self.least = self.most = None
        self.edits: Iterator[str] = iter(())

    def row(self, turn, role, text, n, initial, symbol, fault) -> None:
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1
        self.illegal += n - 1 + (self.before is not None and self.before + initial not in ("su", "ua", "au"))
        self.before = initial
        if fault in ("blank", "duplicate"):
            self.faults[fault] += n
        else:
            self.faults["duplicate"] += n - 1
            self.faults["truncated"] += fault == "truncated"
        edit = next(self.edits)
        self.audit.append(edit)
        for letter in edit:
            if letter == "I":
                self.state = _NEXT[self.state]
                self.cost += INSERT
                self.say("user" if self.state == USER else "assistant", "")
            elif letter == "R":
                self.state = _NEXT[self.state]
                self.cost += REROLE + TRUNCATED * symbol.isupper()
                self.say("user" if self.state == USER else "assistant", text)
            elif letter == "K":
                self.state = _KEEPS[initial, self.state]
                self.cost += TRUNCATED * symbol.isupper()
                self.say(role, text)
            else:
                self.cost += DELETE

    def say(self, role: str, text: str) -> None:
        self.hash.update(b"\n" * (self.messages > 0) + f"{role}:{text}".encode())
        self.messages += 1

    def values(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        audit = "".join(self.audit)
        return gaps, *self.faults.values(), self.illegal, self.cost, audit, self.hash.hexdigest(), self.messages


_RESULT = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
        ("messages", pa.int64()),
    ]
)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one conversation after the other: the edits of a block, then its rows, as they come."""
    now, seen, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(_RESULT.names, r, strict=True)) for r in done], _RESULT)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in batch.schema.names)
        for conv_id, _, kind, block_edits, *row in zip(*columns, strict=True):
            if now is None or conv_id != seen:
                if now is not None:
                    done.append((seen, *now.values()))
                now, seen = _Repaired(), conv_id
            if kind == 1:
                now.edits = iter(block_edits.split(" "))
            elif kind == 2:
                now.row(*row)
        if done:
            yield out()
            done = []
    if now is not None:
        done.append((seen, *now.values()))
        yield out()


def repair(rows: DataFrame, ids: DataFrame | None = None, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Per conversation: ``conv_id``, ``gaps``, faults, ``illegal``, ``cost``, ``audit``,
    ``repaired_sha256`` and ``messages``, the number of repaired ones.

    ``ids`` may name further conversations, which get zeros and the hash of nothing. Rows go by turn
    (nulls first), role and text; equal rows are duplicates of the first. Null ids are one conversation,
    null roles and texts one blank each. Roles count by their first character; any but s, u, a can only
    be re-roled or deleted. An empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    with scratch:
        rows = _columns(rows)
        placed = in_order(rows, scratch)
        kinds = "conv_id", "place", "kind", "edits", "turn", "role", "text", "n", "initial", "symbol", "fault"
        types = dict(placed.dtypes) | {"kind": "int", "edits": "string"}

        def laid_out(part: DataFrame, kind: int) -> DataFrame:
            part = part.withColumn("kind", F.lit(kind))
            return part.select(*[column_or_null(part, c, types[c]) for c in kinds])

        changes = edits(placed, scratch, block_bits=block_bits)
        changes = changes.withColumn("place", F.shiftleft("block", block_bits))
        every = laid_out(placed, 2).union(laid_out(changes, 1))
        if ids is not None:
            every = every.union(laid_out(ids.select(column_or_null(ids, "conv_id", "long")).distinct(), 0))
        # One task for a conversation, since a hash takes its bytes in order; it holds no rows.
        every = every.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")
        schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
        found = every.mapInArrow(_hashed, f"{schema}, audit string, repaired_sha256 string, messages long")
        return kept(found, "repaired")
