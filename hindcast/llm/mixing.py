"""Mixing sources to target weights with a low-discrepancy schedule. DataFrame functions only.

Each source's documents, in shuffled order, are one stream of words, cut into blocks of equal
size. A van der Corput sequence runs over the unit interval, on which every source owns a stretch
as wide as the number of blocks that make up its target: the point of slot t says which source is
next. Slots are numbered per source, and the k-th slot of a source takes its k-th block; what no
slot asks for is not in the mix. A source smaller than its target starts again from its first
block. Every source has at least as many slots as blocks, slots beyond its last block stay empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import WORD, column_or_null, kept

#: Hexadecimal digits of the shuffling hash that cut a source's stream into parts, so that no
#: window holds a whole source: 16 ** 3 parts.
PART_DIGITS = 3
#: Points of the schedule that one row expands to at most, as a power of two.
CHUNK_BITS = 12
#: Ranges of slots in which slots are numbered apart, as a power of two.
RANGE_BITS = 10


def sizes(docs: DataFrame, *, with_rows: bool = False) -> DataFrame:
    """``row`` (unique), ``doc_id``, ``source`` and ``size`` in words, in a scratch table.

    A null text has size 0. Repeated rows, also of the same id, are documents of their own.
    ``with_rows`` adds the whole input row as the struct ``doc``, so no name can clash.
    """
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    whole = [F.struct(*[docs[c] for c in docs.columns]).alias("doc")] if with_rows else []
    found = docs.select(
        column_or_null(docs, "doc_id", "long"),
        column_or_null(docs, "source", "string"),
        size.alias("size"),
        *whole,
    )
    return kept(found.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def targets(
    sized: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2.0,
) -> DataFrame:
    """Per source: ``place`` (by code point, null last), ``source_size``, ``target``.

    Sources get the weights in turn and share ``share`` times all words; no target is above
    ``limit`` times its source's size, what is cut off goes to the others by weight. This table
    has one row per source; the windows over all of it are over these rows.
    """
    if share > limit:
        raise ValueError("the share cannot be above the limit")
    in_turn = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy("key")
    found = (
        sized.groupBy(_key().alias("key"))
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(in_turn, F.col("place") % len(weights) + 1))
        .withColumn("most", F.col("source_size") * F.lit(float(limit)))
    )
    # Sources reach their limit in the order of limit per weight. A source is held at it if the
    # level, once all before it are held, is at least as high.
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("most").over(before), F.lit(0.0)
    )
    free = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    found = found.withColumn("level", left / free).withColumn(
        "held", F.col("most") <= F.col("level") * F.col("weight")
    )
    level = F.max(F.when(~F.col("held"), F.col("level"))).over(everything)
    target = F.when(F.col("held"), F.col("most")).otherwise(
        F.least(F.col("weight") * level, F.col("most"))
    )
    return found.select("key", "place", "source_size", target.alias("target"))


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """Which source each slot serves: ``key``, ``slot``, ``nth`` (of the source, from 0).

    With n blocks in all there are 2 ** bits >= n slots. Point j / 2 ** bits belongs to the source
    on whose stretch it lies and comes up in slot reversed_bits(j), so the stretches are expanded,
    not joined. A stretch of b / n holds at least b points, as its ends are rounded alike.
    """
    goals = goals.withColumn("blocks", F.ceil(_wanted() / block))
    n = int(goals.agg(F.sum("blocks")).first()[0] or 0)
    bits = max(n - 1, 0).bit_length()
    points = 1 << bits
    ends = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # As decimals, for the product leaves the longs behind at some 10 ** 12 words.
    upto = F.sum("blocks").over(ends).cast("decimal(18,0)")
    stretches = (
        goals.withColumn("upto", upto)
        .withColumn("j_to", F.expr(f"(upto * {points}BD + {max(n - 1, 0)}BD) DIV {max(n, 1)}BD"))
        .withColumn("j_from", F.coalesce(F.lag("j_to").over(Window.orderBy("place")), F.lit(0)))
        .where("j_from < j_to")
    )
    chunk = 1 << CHUNK_BITS
    chunks = stretches.select(
        "key",
        "j_from",
        "j_to",
        F.explode(
            F.expr(f"sequence(j_from DIV {chunk}, (j_to - 1) DIV {chunk})")
        ).alias("chunk"),
    ).repartition("key", "chunk")
    slots = chunks.select(
        "key",
        F.explode(
            F.sequence(
                F.greatest("j_from", F.col("chunk") * chunk),
                F.least(F.col("j_to"), (F.col("chunk") + 1) * chunk) - 1,
            )
        ).alias("j"),
    ).select("key", _reversed_bits("j", bits).alias("slot"))
    shift = max(bits - RANGE_BITS, 0)
    slots = slots.withColumn("range", F.shiftright("slot", shift))
    inside = Window.partitionBy("key", "range").orderBy("slot")
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = slots.groupBy("key", "range").agg(F.count("*").alias("here"))
    counts = counts.select(
        "key", "range", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("passed")
    )
    numbered = slots.withColumn("local", F.row_number().over(inside) - 1)
    return numbered.join(counts.hint("merge"), ["key", "range"]).select(
        "key", "slot", (F.col("local") + F.col("passed")).alias("nth")
    )


def mix(
    sized: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2.0,
    block: int = 512,
    seed: str = "mix",
) -> DataFrame:
    """The mix as spans of documents, from a table as :func:`sizes` makes it.

    Columns: ``row``, ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copy`` (0
    for the first time through the source), ``slot``, ``word_from``, ``word_to``. The words of all
    spans of a source are its target, rounded. A document of which nothing is taken has one row
    with null slot, span and copy. An empty table gives an empty mix. Documents are shuffled by
    their ids, those without one by their place in ``sized``.
    """
    goals = kept(targets(sized, weights, share, limit), "mix-targets")
    lines = sized.select("row", "doc_id", "source", "size", _key().alias("key"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), "row"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), name))
    lines = lines.withColumn("hash", order).withColumn(
        "part", F.substring("hash", 1, PART_DIGITS)
    )
    inside = (
        Window.partitionBy("key", "part")
        .orderBy("hash", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("key", "part").agg(F.sum("size").alias("words"))
    parts = (
        parts.select(
            "key", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("passed")
        )
        .join(goals, "key")
        .drop("place")
    )
    starts = lines.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Both sides are shuffled by these keys already; sizes read from compressed files mislead
    # Spark into broadcasting one of them.
    placed = starts.join(parts.hint("merge"), ["key", "part"]).withColumn("start", F.expr("local + passed"))
    copies = int(-(-limit // 1))
    wanted = _wanted()
    spans = (
        placed.withColumn("wanted", wanted)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("at", F.expr("start + copy * source_size"))
        .withColumn("end", F.least(F.expr("at + size"), F.col("wanted")))
        .where("copy = 0 OR (size > 0 AND at < end)")
        .withColumn(
            "block",
            F.explode_outer(
                F.when(
                    F.expr("size > 0 AND at < end"),
                    F.expr(f"sequence(at DIV {block}, (end - 1) DIV {block})"),
                )
            ),
        )
        .withColumn("word_from", F.expr(f"greatest(at, block * {block}) - at"))
        .withColumn("word_to", F.expr(f"least(end, (block + 1) * {block}) - at"))
    )
    slots = schedule(goals, block).withColumnRenamed("nth", "block")
    asked = F.col("slot").isNotNull()
    return spans.join(slots.hint("merge"), ["key", "block"], "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", "slot",
        *[F.when(asked, F.col(c)).alias(c) for c in ("copy", "word_from", "word_to")],
    )


def taken_words(spans: DataFrame) -> DataFrame:
    """One row per document of a mix: how many of its words the mix takes, repeats counted, and
    the first slot that takes any (null if none does)."""
    words = F.coalesce(F.sum(F.expr("word_to - word_from")), F.lit(0))
    by = ["row", "doc_id", "size", "source_size", "target"]
    return spans.groupBy(*by).agg(words.alias("taken"), F.min("slot").alias("first_slot")).drop("row")


def mixture(docs: DataFrame, *, ordered: bool = False, **how) -> DataFrame:
    """The mix itself: the documents' columns, one row for each time a document is taken.

    Where the mix ends inside a document, that copy's text holds the words taken, joined by a
    space, and ``n_chars``, where there is one, counts them. ``ordered`` sorts the rows by the
    first slot of each take, which shuffles all texts once more.
    """
    sized = sizes(docs, with_rows=True)
    spans = mix(sized, **how).where("slot IS NOT NULL")
    takes = spans.groupBy("row", "copy").agg(
        F.max("word_to").alias("word_to"), F.min("slot").alias("slot")
    )
    found = sized.join(takes, "row")
    if ordered:
        found = found.orderBy("slot", "row", "copy")
    words = F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0))
    text = F.array_join(F.slice(words, F.lit(1), F.col("word_to").cast("int")), " ")
    cut = F.when(F.col("word_to") < F.col("size"), text)
    instead = {"text": F.coalesce(cut, F.col("doc.text"))}
    if "n_chars" in docs.columns:
        chars = F.length(cut).cast(dict(docs.dtypes)["n_chars"])
        instead["n_chars"] = F.coalesce(chars, F.col("doc.n_chars"))
    return found.select(*[instead.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def _key():
    """Sorts as the sources do by code point, null last."""
    return F.concat(
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.lit("0")),
        F.coalesce(F.col("source"), F.lit("")),
    )


def _wanted():
    return F.floor(F.col("target") + F.lit(0.5))


def _reversed_bits(column: str, bits: int):
    if not bits:
        return F.col(column)
    return F.conv(F.reverse(F.lpad(F.bin(column), bits, "0")), 2, 10).cast("long")
