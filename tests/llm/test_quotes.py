import random
import re
from collections import defaultdict

import duckdb

from hindcast.llm import quotes
from hindcast.llm.queries import OP4_SQL

MESSAGES = "conv_id long, turn long, role string, text string"


def parse(line):
    marks = re.match(r"[ \t>]*", line)[0]
    return marks.count(">"), re.sub(r"[ \t\r\n\x0B\f]+", " ", line[len(marks) :]).strip(" ").lower()


def brute(rows):
    first = {}
    for c, t, _, text in rows:
        for line in (text or "").split("\n"):
            depth, said = parse(line)
            if depth == 0 and said and None not in (c, t):
                first[c, said] = min(t, first.get((c, said), t))
    parent, linked = {}, defaultdict(set)
    for c, t, _, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            depth, said = parse(line)
            source = first.get((c, said))
            if depth and source is not None and t is not None and source < t:
                linked[c, t].add(k)
                parent[c, t] = max(parent.get((c, t), (-99, 0)), (-depth, source))
    found = []
    for c, t, role, text in rows:
        root, depth = t, 0
        while (c, root) in parent:
            root, depth = parent[c, root][1], depth + 1
        lines = (text or "").split("\n")
        own = None if text is None else "\n".join(x for x in lines if not parse(x)[0])
        quoted = sum(parse(x)[0] > 0 and parse(x)[1] != "" for x in lines)
        up = parent.get((c, t), (0, None))[1]
        found.append((c, t, role, own, quoted, len(linked.get((c, t), ())), up, root, depth))
    return sorted(found, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def mail(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(6):
        said = []
        for t in range(rng.choice([1, 5, 25])):
            lines = []
            if said and rng.random() < 0.8:
                source = rng.choice(said)
                lines += [rng.choice([">", "> ", " >"]) + x.upper() for x in source if rng.random() < 0.8]
            lines += [rng.choice(["", "  "]) + f"Line  {rng.randrange(40)} of {c}\t" for _ in range(rng.randrange(3))]
            said.append(lines)
            rows.append((c, t * 2, rng.choice(["user", "assistant"]), "\n".join(lines)))
    return rows


def chain(n):
    """Each message quotes the one before."""
    return [(7, t, "user", f"say {t}" + (f"\n> say {t - 1}" if t else "")) for t in range(n)]


def test_same_as_brute_force(spark):
    rows = mail() + chain(40)
    rows += [rows[3], (0, 4, "user", "> unknown\n>> deeper\n>")]
    frame = quotes.conversations(spark.createDataFrame(rows, MESSAGES).repartition(3))
    found = got(frame)
    assert found == brute(rows)
    assert max(r[8] for r in found) == 39 and sum(r[5] for r in found) > 40


def test_threads_stand_together(spark):
    rows = mail(4)
    order = [(r.conv_id, r.root_turn, r.turn) for r in quotes.conversations(spark.createDataFrame(rows, MESSAGES)).collect()]
    assert order == sorted(order)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "hi"), (None, 2, "user", "> hi"), (1, None, "user", "hi"), (1, None, None, "> hi"),
        (1, 1, "user", None), (1, 2, "user", ""), (1, 3, "user", "> "), (1, 4, "user", ">" * 70_000 + "x"),
        (2, 1, "user", "x " * 100_000), (2, 2, "user", "> " + "X " * 100_000), (2, 2, "user", "> " + "X " * 100_000),
    ]
    frame = spark.createDataFrame(rows, MESSAGES).selectExpr("*", "1 AS depth", "2 AS parent_turn", "3 AS place")
    assert got(quotes.conversations(frame)) == brute(rows)
    assert quotes.conversations(frame.where("false")).collect() == []


def test_sql_says_the_same(spark):
    rows = mail(3) + chain(20) + [(9, 1, "user", None)]
    frame = spark.createDataFrame(rows, MESSAGES)
    con = duckdb.connect()
    con.register("conversations", frame.toPandas())
    found = con.execute(OP4_SQL)
    names = [c[0] for c in found.description]
    clean = lambda x: None if x is None or x != x else x  # noqa: E731  pandas turns null turns to NaN
    want = sorted((tuple(map(clean, r)) for r in found.fetchall()), key=str)
    assert sorted((tuple(r) for r in quotes.conversations(frame).select(*names).collect()), key=str) == want


def test_wrapped_anew_and_partial_quotes(spark):
    rows = [
        (1, 0, "user", "Alpha beta gamma delta epsilon zeta. And one more sentence stands here.\nshort line"),
        (1, 1, "user", "nothing\nof\nthe kind"),
        (1, 2, "user", "> alpha beta  gamma\n> DELTA epsilon zeta.\nyes"),
        (1, 3, "user", "> one more sentence stands\nno"),
        (1, 4, "user", "> nothing of the kind\nwell"),
        (1, 5, "user", "> pha beta gamma delta\n> gamma\n\n> beta of"),
        (1, 6, "user", "> short\n> line"),
        (2, 0, "user", "> one more sentence stands"),
    ]
    frame = quotes.conversations(spark.createDataFrame(rows, MESSAGES))
    found = {(r.conv_id, r.turn): (r.n_quoted, r.n_linked, r.parent_turn) for r in frame.collect()}
    assert [found[1, t] for t in range(2, 7)] == [(2, 2, 0), (1, 1, 0), (1, 1, 1), (3, 0, None), (2, 2, 0)]
    assert found[2, 0] == (1, 0, None)
