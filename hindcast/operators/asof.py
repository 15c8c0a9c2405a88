"""As-of joins: give each decision the version it could have known, and none from its future."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.contract import BUSINESS_KEY
from hindcast.functions.columns import slice_start
from hindcast.operators.reads import NEWEST

DAY = 86400


def asof_join(
    decisions: DataFrame,
    versions: DataFrame,
    *,
    on: Sequence[str] | None = None,
    decision_at: str = "decision_at",
    payload: Sequence[str] = ("value", "source"),
    how: str = "inner",
    slice_seconds: int = DAY,
) -> DataFrame:
    """Attach to each decision the newest version of its key with ``posted_at <= decision_at``.

    The key is the business key, and the product where both sides name it. All keys go the same
    way. Versions collapse to one per key and stamp, decisions to one question per key and instant,
    both with map-side combining. Time is cut into slices; a slice of a key is one sorted run, in
    which a running ``last`` finds the answers. What was known before a slice is carried in as its
    first row, from one row per key and slice. No pair of versions and decisions is formed, and no
    job runs before the result is used.

    A version without ``posted_at`` is never known. A decision without an instant or a key part
    knows nothing; ``how="left"`` keeps it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    keys = list(on or shared_key(decisions, versions))
    cell = [*keys, "_slice"]

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_slice", slice_start(F.col("_at"), slice_seconds))

    known = versions.where("posted_at IS NOT NULL").withColumn("_at", F.col("posted_at"))
    single = placed(
        known.groupBy(*keys, "_at").agg(F.max(newest_first(versions, payload)).alias("_version"))
    )
    questions = placed(
        decisions.select(*keys, F.col(decision_at).alias("_at")).where("_at IS NOT NULL").distinct()
    )
    nothing = F.lit(None).cast(single.schema["_version"].dataType)
    timeline = single.withColumn("_question", F.lit(False)).unionByName(
        questions.withColumns({"_question": F.lit(True), "_version": nothing})
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        timeline.groupBy(*cell)
        .agg(F.max("_version").alias("_version"), F.bool_or("_question").alias("_asked"))
        .withColumn("_version", F.last("_version", ignorenulls=True).over(before))
        .where("_asked AND _version IS NOT NULL")
        .select(*cell, F.col("_slice").alias("_at"), "_version", F.lit(False).alias("_question"))
    )
    so_far = (
        Window.partitionBy(*cell)
        .orderBy("_at", "_question", "_version")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        timeline.unionByName(carried)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .where("_question AND _version IS NOT NULL")
        .select(*keys, F.col("_at").alias(decision_at), "_version")
    )
    found = decisions.join(answers, [*keys, decision_at], how)
    version = [F.col("_version")[c].alias(c) for c in ("posted_at", "ingested_at", *payload)]
    return found.select(*[decisions[c] for c in decisions.columns], *version)


def shared_key(decisions: DataFrame, versions: DataFrame) -> tuple[str, ...]:
    """The business key, with the product where both tables have one."""
    both = "product" in decisions.columns and "product" in versions.columns
    return ("product", *BUSINESS_KEY) if both else BUSINESS_KEY


def newest_first(versions: DataFrame, payload: Sequence[str]) -> Column:
    """A version as a struct whose maximum is the one a snapshot takes."""
    order = [c for c in NEWEST if c in versions.columns]
    return F.struct(*order, *[c for c in payload if c not in order])


def multi_snapshot(
    decisions: DataFrame,
    versions: DataFrame,
    *,
    payload: Sequence[str] = ("value", "source"),
) -> DataFrame:
    """A snapshot for every decision at once: ``(decision_at, valid_from, valid_to)`` in, one row
    per decision and business key out, equal to one snapshot per decision.

    Decisions that read an interval are numbered in their order. Each version is put down to the
    first of them that could know it, and only the newest per key and number goes on; it answers
    every decision up to the next one's number. So no version meets the decisions it could serve.
    Where versions name a product it is part of the key; where decisions do too, each applies to
    its own product alone.
    """
    key = (["product"] if "product" in versions.columns else []) + list(BUSINESS_KEY)
    own = ["product"] if "product" in decisions.columns and "product" in versions.columns else []
    interval = [*own, "interval_start"]
    asked = _asked_intervals(decisions, versions, own).withColumnRenamed("decision_at", "_at")

    in_order = Window.partitionBy(*interval).orderBy("_at")
    numbered = asked.withColumn("_number", F.row_number().over(in_order))
    # The first decision at or after each stamp: one more than there are before it.
    stamps = versions.where("posted_at IS NOT NULL").select(
        *interval, F.col("posted_at").alias("_at"), F.lit(0).alias("_asks")
    )
    timeline = stamps.distinct().unionByName(asked.withColumn("_asks", F.lit(1)))
    passed = Window.partitionBy(*interval).orderBy("_at", "_asks").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    all_of_it = Window.partitionBy(*interval)
    first_known = (
        timeline.withColumn("_since", F.sum("_asks").over(passed) + 1)
        .withColumn("_most", F.sum("_asks").over(all_of_it))
        .where("_asks = 0 AND _since <= _most")
        .select(*interval, F.col("_at").alias("posted_at"), "_since", "_most")
    )
    newest = (
        versions.join(first_known, [*interval, "posted_at"])
        .groupBy(*key, "_since")
        .agg(
            F.max(newest_first(versions, payload)).alias("_version"), F.max("_most").alias("_most")
        )
    )
    following = F.lead("_since").over(Window.partitionBy(*key).orderBy("_since"))
    until = F.coalesce(following - 1, F.col("_most"))
    answers = newest.withColumn("_until", until).select(
        *key, F.explode(F.sequence("_since", "_until")).alias("_number"), "_version"
    )
    return (
        answers.join(numbered, [*interval, "_number"])
        .select(F.col("_at").alias("decision_at"), *key, "_version.*")
        .select("decision_at", *key, "posted_at", "ingested_at", *payload)
    )


def _asked_intervals(decisions: DataFrame, versions: DataFrame, own: list[str]) -> DataFrame:
    """Each decision with every interval in its range that has versions at all, days matched first."""
    day = F.to_date("interval_start").alias("_day")
    there = versions.select(*own, "interval_start").distinct().withColumn("_day", day)
    last = F.to_date(F.col("valid_to") - F.expr("INTERVAL 1 MICROSECOND"))
    days = F.explode(F.sequence(F.to_date("valid_from"), last)).alias("_day")
    wanted = decisions.where("valid_from < valid_to AND decision_at IS NOT NULL").select(
        *own, "decision_at", "valid_from", "valid_to", days
    )
    return (
        wanted.join(there, [*own, "_day"])
        .where("interval_start >= valid_from AND interval_start < valid_to")
        .select(*own, "decision_at", "interval_start")
        .distinct()
    )
