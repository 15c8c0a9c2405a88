"""Which polls brought something new, and how fresh each product is."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.columns import age_minutes, instant, slice_start

MONTH = 30 * 86400


def one_per_poll(polls: DataFrame) -> DataFrame:
    """One row per product and fetch time; a poll that was published once stays published."""
    rest = [c for c in polls.columns if c not in ("product", "fetched_at", "new_posting")]
    return (
        polls.groupBy("product", "fetched_at")
        .agg(F.max(F.struct("new_posting", *rest)).alias("_p"))
        .select("product", "fetched_at", "_p.*")
    )


def mark_changes(polls: DataFrame, slice_seconds: int = MONTH) -> DataFrame:
    """Add ``changed``: the digest differs from the product's previous poll, or there is none.

    Expects one row per product and fetch time. The comparison runs within time slices, and the
    last digest of the slice before is handed to each slice's first poll, so a product with
    very many polls is never sorted in one task.
    """
    sliced = polls.withColumn("_slice", slice_start(F.col("fetched_at"), slice_seconds))
    by_slice = Window.partitionBy("product").orderBy("_slice")
    carried = (
        sliced.groupBy("product", "_slice")
        .agg(F.max_by("digest", "fetched_at").alias("_end"))
        .select("product", "_slice", F.lag("_end").over(by_slice).alias("_carried"))
    )
    within = Window.partitionBy("product", "_slice").orderBy("fetched_at")
    return (
        sliced.withColumn("_before", F.lag("digest").over(within))
        .join(carried, ["product", "_slice"])
        .withColumn("changed", ~F.col("digest").eqNullSafe(F.coalesce("_before", "_carried")))
        .drop("_slice", "_before", "_carried")
    )


def latest_manifest(polls: DataFrame) -> DataFrame:
    """Per product: the newest posting and the time of the last poll, posting or not."""
    posting = F.when(
        F.col("new_posting"),
        F.struct("fetched_at", "digest", "rows", "dropped", "valid_from", "valid_to",
                 "partitions", "raw_key"),
    )
    newest = polls.groupBy("product").agg(
        F.max(posting).alias("p"), F.max("fetched_at").alias("last_checked_at")
    )
    return newest.select(
        "product",
        F.col("p.fetched_at").alias("last_posted_at"),
        "last_checked_at",
        F.col("p.digest").alias("content_hash"),
        "p.rows", "p.dropped", "p.valid_from", "p.valid_to", "p.partitions", "p.raw_key",
    )


def freshness(
    postings: DataFrame,
    now: datetime,
    *,
    stale_after_min: float | Column,
    posted_at: str = "posted_at",
) -> DataFrame:
    """Minutes since each product's newest posting, and whether that is too long."""
    newest = postings.groupBy("product").agg(F.max(posted_at).alias("last_posted_at"))
    age = age_minutes(F.col("last_posted_at"), instant(now))
    return newest.withColumn("age_minutes", age).withColumn(
        "stale", F.col("age_minutes") > F.lit(stale_after_min)
    )


def alarm_hours(
    checks: DataFrame, start: datetime, end: datetime, *, threshold_min: float
) -> DataFrame:
    """Per hour that ``[start, end)`` touches: the greatest age checked, whether the hour breaches,
    and whether it and the hour before both do. An hour without a check breaches. The hour before
    the first is looked at too, from checks of the whole hour."""
    hour = F.make_dt_interval(hours=F.lit(1))
    first = F.date_trunc("hour", instant(start))
    hours = checks.sparkSession.range(1).select(
        F.explode(
            F.sequence(first - hour, instant(end) - F.expr("INTERVAL 1 MICROSECOND"), hour)
        ).alias("hour")
    )
    worst = (
        checks.where((F.col("checked_at") >= first - hour) & (F.col("checked_at") < instant(end)))
        .groupBy(F.date_trunc("hour", "checked_at").alias("hour"))
        .agg(F.max("age_minutes").alias("max_age_minutes"))
    )
    over = F.col("max_age_minutes") > F.lit(float(threshold_min))
    breaches = hours.join(worst, "hour", "left").withColumn(
        "breach", F.coalesce(over, F.lit(True))
    )
    before = breaches.select((F.col("hour") + hour).alias("hour"), F.col("breach").alias("_before"))
    return (
        breaches.where(F.col("hour") >= first)
        .join(before, "hour")
        .withColumn("alarm", F.col("breach") & F.col("_before"))
        .drop("_before")
    )
