"""Freshness as a stream: the greatest posting age per hour, and the alarm over it."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hindcast.functions.columns import instant

HOUR = 3600
OPEN = "due long, before boolean, hours array<long>, ages array<double>"
CLOSED = "product string, hour long, max_age_minutes double, breach boolean, alarm boolean"


def hourly_ages(checks: DataFrame) -> DataFrame:
    """Greatest age checked per hour, from a stream or table of ``(checked_at, age_minutes)``.

    On a stream it is written in update mode: an hour is given again whenever a check of it comes
    in, however late. The state is one row per hour, so there is no need for a watermark, which
    would drop late checks for good. Hours without any check are found afterwards, against the
    calendar, by ``alarm_hours``, or as they pass by :func:`hourly_alarms`.
    """
    return (
        checks.groupBy(F.window("checked_at", "1 hour").alias("w"))
        .agg(F.max("age_minutes").alias("max_age_minutes"))
        .select(F.col("w.start").alias("hour"), "max_age_minutes")
    )


def hourly_alarms(
    checks: DataFrame,
    start: datetime,
    *,
    threshold_min: float,
    grace_hours: int = 1,
    clock: DataFrame | None = None,
) -> DataFrame:
    """What ``alarm_hours`` finds, product by product and as each hour ends, in append mode.

    ``checks`` is a stream of ``(product, checked_at, age_minutes)``. An hour is closed, and given
    once, when anything has been seen ``grace_hours`` after its end, a check of whichever product
    or a stamp of ``clock``. That is a stream with a column ``timestamp``, such as Spark's ``rate``
    source; with it hours end also while nobody checks anything. An hour closed without a check
    breaches. Hours are counted from ``start``, for every product that was ever checked; the hour
    before counts as breaching.

    Checks without a product or a time, before ``start``, or of closed hours do not count; ages
    that are null or not a number are no ages, and an hour of only these breaches. The state is
    one row per product, as long as the hours still open. Checks are reduced to one per product
    and hour in each batch of Arrow before they are shuffled, so a product with very many of them
    is no large group.
    """
    hour = F.unix_seconds(F.date_trunc("hour", "checked_at"))
    age = F.when(~F.isnan("age_minutes"), F.col("age_minutes")).cast("double")
    seen = checks.where("product IS NOT NULL AND checked_at IS NOT NULL").where(
        F.col("checked_at") >= F.date_trunc("hour", instant(start))
    )
    seen = seen.select(F.col("product").cast("string"), hour.alias("hour"), age.alias("age"))
    if clock is not None:  # the group without a product keeps no state
        passing = F.unix_seconds(F.date_trunc("hour", "timestamp")).alias("hour")
        seen = seen.unionByName(clock.select(passing), allowMissingColumns=True)
    ends = F.timestamp_seconds(F.col("hour") + HOUR)
    reduced = seen.mapInArrow(_greatest, "product string, hour long, age double")
    # The watermark runs over the ends of hours: what Spark drops as late are closed hours only.
    timed = reduced.withColumn("ends", ends).withWatermark("ends", f"{grace_hours + 1} hours")
    first = int(start.timestamp()) // HOUR * HOUR
    closed = timed.groupBy("product").applyInPandasWithState(
        partial(_close, first=first, threshold=float(threshold_min)),
        CLOSED, OPEN, "append", GroupStateTimeout.EventTimeTimeout,
    )
    return closed.withColumn("hour", F.timestamp_seconds("hour"))


def _greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        most = pa.Table.from_batches([batch]).group_by(["product", "hour"]).aggregate([("age", "max")])
        yield from most.rename_columns(["product", "hour", "age"]).to_batches()


def _close(
    key: tuple[str | None], chunks: Iterator[pd.DataFrame], state: GroupState,
    *, first: int, threshold: float,
) -> Iterator[pd.DataFrame]:
    """Take in a product's checks and give the hours that the watermark has passed."""
    if key[0] is None:
        return
    due, before, hours, ages = state.get if state.exists else (first, True, [], [])
    open_hours = dict(zip(hours, ages, strict=True))
    for chunk in [] if state.hasTimedOut else chunks:
        most = chunk[chunk["hour"] >= due].groupby("hour")["age"].max()
        for hour, age in most.items():
            known = [a for a in (open_hours.get(hour), age) if a is not None and a == a]
            open_hours[int(hour)] = max(known, default=None)
    rows = []
    while (due + HOUR) * 1000 <= state.getCurrentWatermarkMs():
        age = open_hours.pop(due, None)
        breach = age is None or age > threshold
        rows.append((key[0], due, age, breach, breach and before))
        due, before = due + HOUR, breach
    state.update((due, before, list(open_hours), list(open_hours.values())))
    # Fires once the watermark is at the hour's end, be there checks of this product or not.
    state.setTimeoutTimestamp((due + HOUR) * 1000 - 1)
    if not rows:
        return
    names = [c.split()[0] for c in CLOSED.split(", ")]
    yield pd.DataFrame(rows, columns=names).astype({"max_age_minutes": "float64"})
