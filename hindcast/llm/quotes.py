"""Linking quotations in messages to what they quote.

Lines that start with ``>`` are quoted, as deep as there are ``>``. A quoted line is looked up by a
hash of its normalised text among the unquoted lines of its conversation; the message that said it
first is its source. Lines that find none, since a mail client wrapped them anew or they are part of
a line, are looked up as passages: the quoted lines around them at one depth, joined, must be in the
unquoted text of a message, whatever its line breaks. A message replies to the source of what it quotes least deep, the latest one
if there are several. Replies form trees, whose roots are found by doubling the steps up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import column_or_null, kept

MARKS = r"^[ \t>]*"
KEY = ["conv_id", "turn"]
#: Words in the windows by which passages are looked up; shorter passages must be whole lines.
WINDOW = 4


def _depth(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def _normalised(line: Column) -> Column:
    """Without marks and case, white space runs as one blank."""
    plain = F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\r\n\x0B\f]+", " ")
    return F.lower(F.trim(plain))


def _lines(messages: DataFrame) -> DataFrame:
    """Lines with something in them: the message, ``place``, ``depth``, ``said``, ``hash``."""
    rows = messages.select(*KEY, F.md5("text").alias("message"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    rows = rows.select(*KEY, "message", "place", _depth(F.col("line")).alias("depth"), _normalised(F.col("line")).alias("said"))
    return rows.where("said <> ''").withColumn("hash", F.md5("said"))


def links(messages: DataFrame) -> DataFrame:
    """Quoted lines with a source: ``conv_id``, ``turn``, ``place``, ``depth``, ``source_turn``.

    The first message that says a line is one row per conversation and line, so a line said very
    often adds nothing to the join.
    """
    lines = _lines(messages)
    said = lines.where("depth = 0 AND conv_id IS NOT NULL AND turn IS NOT NULL")
    first = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("source_turn"))
    quoted = lines.where("depth > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL")
    by_line = quoted.join(first, ["conv_id", "hash"]).where("source_turn < turn")
    by_line = kept(by_line.select(*KEY, "place", "depth", "source_turn"), "quoted-lines")
    rest = kept(_passages(quoted, by_line), "quoted-passages")
    if rest.isEmpty():
        return by_line
    return by_line.union(_passage_links(rest, first, said))


def _passages(quoted: DataFrame, linked: DataFrame) -> DataFrame:
    """Passages with lines that are not linked: ``said``, its ``hash``, and those lines' ``places``."""
    lines = quoted.select(*KEY, "message", "depth", "place", "said").distinct()
    known = linked.select(*KEY, "place").distinct().withColumn("known", F.lit(True))
    lines = lines.join(known, [*KEY, "place"], "left")
    run = Window.partitionBy(*KEY, "message", "depth").orderBy("place")
    lines = lines.withColumn("run", F.col("place") - F.row_number().over(run))
    parts = F.sort_array(F.collect_list(F.struct("place", "said")))
    found = lines.groupBy(*KEY, "message", "depth", "run").agg(
        F.array_join(parts["said"], " ").alias("said"),
        F.collect_list(F.when(F.col("known").isNull(), F.col("place"))).alias("places"),
    )
    return found.where(F.size("places") > 0).withColumn("hash", F.md5("said"))


def _windows(said: Column) -> Column:
    words = F.split(said, " ")
    starts = F.sequence(F.lit(1), F.size(words) - WINDOW + 1)
    each = F.transform(starts, lambda k: F.xxhash64(F.array_join(F.slice(words, k, WINDOW), " ")))
    return F.when(F.size(words) >= WINDOW, F.array_distinct(each))


def _passage_links(rest: DataFrame, first: DataFrame, said: DataFrame) -> DataFrame:
    """As :func:`links`, for lines of passages: the first message that holds the whole passage."""
    whole = rest.join(first, ["conv_id", "hash"]).where("source_turn < turn")
    found = whole.select(*KEY, "message", "depth", "run", "places", "source_turn")
    parts = F.sort_array(F.collect_list(F.struct("place", "said")))
    here = said.join(rest.select("conv_id").distinct(), "conv_id", "left_semi")
    here = here.select(*KEY, "message", "place", "said").distinct()
    here = here.groupBy("conv_id", F.col("turn").alias("source_turn"), "message").agg(
        F.array_join(parts["said"], " ").alias("text")
    )
    here = kept(here.withColumnRenamed("message", "source"), "quote-sources")
    places = here.select("conv_id", "source_turn", "source", F.explode(_windows(F.col("text"))).alias("window"))
    asked = rest.withColumn("window", _windows(F.col("said"))[0]).where("window IS NOT NULL")
    maybe = asked.join(places, ["conv_id", "window"]).where("source_turn < turn")
    blank = F.lit(" ")
    holds = F.contains(F.concat(blank, "text", blank), F.concat(blank, "said", blank))
    inside = maybe.join(here, ["conv_id", "source_turn", "source"]).where(holds)
    found = found.union(inside.select(*found.columns))
    found = found.groupBy(*KEY, "message", "depth", "run", "places").agg(F.min("source_turn").alias("source_turn"))
    return found.select(*KEY, F.explode("places").alias("place"), "depth", "source_turn")


def reply_trees(quoted: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``parent_turn``, ``root_turn``, ``depth`` of messages that reply.

    Each round steps as far up as all rounds before together; every step goes to an earlier turn,
    so the rounds end.
    """
    nearest = F.max(F.struct((-F.col("depth")).alias("d"), "source_turn"))
    parents = quoted.groupBy(*KEY).agg(nearest["source_turn"].alias("parent_turn"))
    steps = kept(
        parents.withColumn("root_turn", F.col("parent_turn")).withColumn("steps", F.lit(1)), "replies"
    )
    while True:
        above = steps.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"), F.col("steps").alias("more"))
        joined = steps.join(above, ["conv_id", "root_turn"], "left")
        if joined.where("up IS NOT NULL").isEmpty():
            return steps.withColumnRenamed("steps", "depth")
        steps = kept(
            joined.select(
                *KEY, "parent_turn",
                F.coalesce("up", "root_turn").alias("root_turn"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            ),
            "replies",
        )


def conversations(messages: DataFrame) -> DataFrame:
    """Messages without quotations, in the order of their replies.

    Columns: ``conv_id``, ``turn``, ``role``, ``text`` (unquoted lines as they are), ``n_quoted``
    (lines quoted), ``n_linked`` (those with a source), ``parent_turn`` (null if it replies to
    none), ``root_turn`` (itself, then), ``depth``. Sorted by conversation, root and turn: a thread
    stands together and an answer after what it answers. A null text stays null; messages without
    conversation or turn link to nothing; repeated turns are one message in several rows, which
    share their links. An empty table gives an empty result.
    """
    rows = messages.select(
        column_or_null(messages, "conv_id", "long"), column_or_null(messages, "turn", "long"),
        column_or_null(messages, "role", "string"), column_or_null(messages, "text", "string"),
    )
    quoted = kept(links(rows), "quotes")
    trees = reply_trees(quoted)
    linked = quoted.groupBy(*KEY).agg(F.count_distinct("place").alias("n_linked"))
    lines = F.split("text", "\n")
    own = F.array_join(F.filter(lines, lambda line: _depth(line) == 0), "\n")
    many = F.size(F.filter(lines, lambda line: (_depth(line) > 0) & (_normalised(line) != "")))
    found = rows.join(trees, KEY, "left").join(linked, KEY, "left").select(
        *KEY,
        "role",
        F.when(F.col("text").isNotNull(), own).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(many).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    return found.orderBy("conv_id", "root_turn", "turn")
