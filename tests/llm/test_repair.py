import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from hindcast.llm import repair
from hindcast.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"


def brute_damaged(rows):
    found = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        found += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return found


def brute_edits(rows):
    """Dynamic programme over (cost, audit, roles) itself; rows are (initial, must go, truncated)."""

    @cache
    def best(i, state):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if i < len(rows):
            initial, gone, cut = rows[i]
            ways += [(3 + c, "D" + a, r) for c, a, r in (best(i + 1, state),)]
            if not gone:
                turn = "a" if state == "u" else "u"
                if initial == turn or initial == "s" and state == "":
                    c, a, r = best(i + 1, initial)
                    ways.append((cut + c, "K" + a, (("K", i), *r)))
                c, a, r = best(i + 1, turn)
                ways.append((2 + cut + c, "R" + a, ((turn, i), *r)))
        return min(ways + inserted(i, state), key=lambda w: w[:2])

    @cache
    def without(i, state):  # no insertion first
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if i < len(rows):
            initial, gone, cut = rows[i]
            c, a, r = best(i + 1, state)
            ways.append((3 + c, "D" + a, r))
            if not gone:
                turn = "a" if state == "u" else "u"
                if initial == turn or initial == "s" and state == "":
                    c, a, r = best(i + 1, initial)
                    ways.append((cut + c, "K" + a, (("K", i), *r)))
                c, a, r = best(i + 1, turn)
                ways.append((2 + cut + c, "R" + a, ((turn, i), *r)))
        return ways

    def inserted(i, state):
        ways, before, roles = [], "", ()
        for n in range(1, 4):
            state = "a" if state == "u" else "u"
            before, roles = before + "I", (*roles, (state, None))
            ways += [(2 * n + c, before + a, roles + r) for c, a, r in without(i, state)]
        return ways

    return best(0, "")


def brute(rows):
    after = brute_damaged(rows)
    found = []
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, symbols = set(), {"b": 0, "d": 0, "t": 0}, []
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            symbols.append((role[:1], fault in ("b", "d"), fault == "t"))
        cost, audit, roles = brute_edits(symbols)
        turns = {r[0] for r in mine if r[0] is not None}
        said = []
        for what, i in roles:
            name = mine[i][1] if what == "K" else {"u": "user", "a": "assistant"}[what]
            said.append(f"{name}:{'' if i is None else mine[i][2]}")
        initials = [s[0] for s in symbols]
        found.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *faults.values(),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
                cost,
                audit,
                hashlib.sha256("\n".join(said).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def got(spark, rows, **how):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = repair.repair(repair.damaged(frame), frame, **how)
    return sorted([tuple(r[c] for c in NAMES) for r in found.collect()], key=str)


def conversations(seed, many, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(many):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 1, 2])
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "Sys", "usr"])
            text = rng.choice(["Hi.", "So?", "no end", "Wow!", "", " \n", None, "é", "a. ", "x", f"t{rng.random()}."])
            rows.append((conv, turn if rng.random() < 0.97 else None, role, text))
    return rows


def test_as_by_hand(spark):
    rows = conversations(1, 250, 9) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 1, "user", "Hi.")]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("bits", [0, 2])
def test_blocks_do_not_matter(spark, monkeypatch, bits):
    rows = conversations(2, 30, 60)
    assert got(spark, rows, block_bits=bits) == brute(rows)


def test_short_auctions(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(repair, "AUCTION", 3)
    for _ in range(400):
        rows = [(rng.choice("suaoSUAOx"), rng.choice([1, 1, 1, 2])) for _ in range(rng.randint(1, 14))]
        plain = []
        for s, n in rows:
            plain += [(s.lower(), s == "x", s.isupper())] + [("", True, False)] * (n - 1)
        cost, audit, _ = brute_edits(plain)
        ((paid, state, ways),) = repair.traced(rows, repair.END_PRICES, (0,))
        assert (paid, "".join(ways) + repair.END_EDITS[state]) == (cost, audit)
        chained = min(a + b for a, b in zip(repair.costs(rows)[0], repair.END_PRICES, strict=True))
        assert chained == cost


def test_prices_are_dual_feasible():
    rng = random.Random(6)
    for _ in range(200):
        rows = [(rng.choice("suaoSUAOx"), 1) for _ in range(rng.randint(1, 30))]
        lattice = repair.Lattice(rows, repair.END_PRICES)
        for state in range(4):
            lattice.auction(state)
        for node in range(lattice.end):
            assert all(lattice.prices[node] <= cost + lattice.prices[to] for _, cost, to in lattice.arcs(node))


def test_repeated_rows_and_everything_dropped(spark):
    rows = [(7, 3, "user", "Same.")] * 40 + [(7, k, "assistant", "Same.") for k in range(60)]
    dropped = next(k for k in range(10**4) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "x")]
    found = got(spark, rows)
    assert found == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found


def test_long_text_and_clashing_columns(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], "w " * 200_000 + f"{k}.") for k in range(6)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "'K' AS edits", "2 AS n", "'c' AS said")
    found = repair.repair(repair.damaged(frame), frame).collect()
    assert [tuple(r[c] for c in NAMES) for r in found] == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_query_on_the_test_table(spark):
    from hindcast.llm.queries import op12_repair

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select(*NAMES[:1], "turn", "role", "text").collect()]
    found = op12_repair(spark, folder).collect()
    assert sorted([tuple(r[c] for c in NAMES) for r in found], key=str) == brute(rows)
