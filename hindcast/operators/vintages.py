"""Comparing versions of the same valid hour, and lining forecasts up with other series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.contract import BUSINESS_KEY
from hindcast.functions.columns import (
    backfill_posted_at,
    finite,
    lead_minutes,
    variable_of,
    zone_of,
)
from hindcast.operators.reads import latest

# Variables that describe the hour before their stamp.
PRECEDING_HOUR = ("precipitation", "shortwave_radiation")


def lead_table(rows: DataFrame, days: Sequence[int], *, hours_late: int = 1) -> DataFrame:
    """One row per business key, one ``lead_<N>d`` column per lead: the value predicted N days
    ahead, as the newest version whose lead is within ``(N - 1 day, N day]`` late by the lag."""
    minutes = lead_minutes(F.col("interval_start"), F.col("posted_at")) + hours_late * 60
    lead = F.ceil(minutes / 1440).cast("int")
    newest = latest(
        rows.withColumn("lead", lead).where(F.col("lead").isin(list(days))),
        (*BUSINESS_KEY, "lead"),
    )
    columns = [
        F.max(F.when(F.col("lead") == n, F.col("value"))).alias(f"lead_{n}d") for n in days
    ]
    return newest.groupBy(*BUSINESS_KEY).agg(*columns)


def unpivot_leads(
    wide: DataFrame, ids: Sequence[str], columns: Sequence[str], *, lag_minutes: int = 60
) -> DataFrame:
    """Turn ``<variable>_previous_dayN`` columns into rows of variable, lead and value, each
    with the moment it was certainly known. Values that are not real numbers are left out."""
    cells = []
    for column in columns:
        variable, found, n = column.rpartition("_previous_day")
        if not found or not n.isdigit():
            raise ValueError(f"{column!r} is not named <variable>_previous_day<N>")
        cells.append(
            F.struct(
                F.lit(variable).alias("variable"),
                F.lit(int(n)).alias("lead"),
                F.col(column).cast("double").alias("value"),
            )
        )
    long = wide.select(*ids, F.inline(F.array(*cells))).where(finite(F.col("value")))
    known = backfill_posted_at(F.col("interval_start"), F.col("lead"), F.lit(lag_minutes))
    return long.select(*ids, "variable", "lead", known.alias("posted_at"), "value")


def revisions(rows: DataFrame) -> DataFrame:
    """How far each version moved from the one before it.

    Grouped by key and lead day, so a key with very many versions is spread over several
    groups; the first version of a lead day is compared with the last of the one before.
    """
    key, cell = list(BUSINESS_KEY), [*BUSINESS_KEY, "lead_day"]
    lead_day = F.floor(lead_minutes(F.col("interval_start"), F.col("posted_at")) / 1440)
    versions = (
        rows.groupBy(*key, "posted_at")
        .agg(F.max(F.struct("ingested_at", "source", "value")).alias("_v"))
        .select(*key, lead_day.cast("int").alias("lead_day"), "posted_at", "_v.value")
    )
    by_day = Window.partitionBy(*key).orderBy(F.col("lead_day").desc())
    carried = (
        versions.groupBy(*cell)
        .agg(F.max_by("value", "posted_at").alias("_end"))
        .select(*cell, F.lag("_end").over(by_day).alias("_carried"))
    )
    within = Window.partitionBy(*cell).orderBy("posted_at")
    return (
        versions.withColumn("previous", F.lag("value").over(within))
        .join(carried, cell)
        .withColumn("previous", F.coalesce("previous", "_carried"))
        .withColumn("change", F.col("value") - F.col("previous"))
        .drop("_carried")
    )


def hour_starting(rows: DataFrame, preceding: Sequence[str] = PRECEDING_HOUR) -> DataFrame:
    """Shift variables that describe the preceding hour back, so a row covers its own hour."""
    earlier = F.col("interval_start") - F.make_dt_interval(hours=F.lit(1))
    shifted = F.when(variable_of(F.col("series")).isin(list(preceding)), earlier)
    return rows.withColumn("interval_start", F.coalesce(shifted, F.col("interval_start")))


def join_zone_series(
    forecast: DataFrame,
    other: DataFrame,
    *,
    preceding: Sequence[str] = PRECEDING_HOUR,
    how: str = "inner",
) -> DataFrame:
    """Join to a sibling table of zone series on ``(interval_start, zone)``."""
    aligned = hour_starting(forecast, preceding).withColumn("zone", zone_of(F.col("series")))
    return aligned.join(other, ["interval_start", "zone"], how)


def with_units(rows: DataFrame, variables: DataFrame) -> DataFrame:
    """Add each row's unit from the catalog's ``(variable, unit)`` table."""
    return rows.withColumn("variable", variable_of(F.col("series"))).join(
        variables.select("variable", "unit"), "variable", "left"
    )


def overlap_join(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], *, value: str = "value", bin_minutes: int = 1440
) -> DataFrame:
    """Bring another resolution to these rows' intervals: each row with ``other_value``, the mean of the
    other table's values weighted by the minutes they share with it, and ``shared_minutes``.

    Both tables say how long a row's interval is by ``interval_minutes``. Rows that share nothing with
    the other table, or a key with none of its rows, keep null and 0. Nulls and other values that are
    not finite count as not there; equal rows are each brought their own.

    Intervals are cut at the edges of bins and joined by key and bin, so that work goes with the
    pairs that overlap, not with all of a key's rows; what a row shares is added up over its bins.
    """
    step = bin_minutes * 60
    interval = [*keys, "interval_start", "interval_minutes"]
    left = rows.select(*interval).distinct()  # rows of one interval share the same
    left = left.withColumns({"_start": F.col("interval_start"), "_minutes": F.col("interval_minutes")})
    left = _binned(left, step)
    right = other.where(finite(F.col(value))).select(*interval, F.col(value).alias("_v"))
    right = _binned(right, step).withColumnsRenamed({"_from": "_other_from", "_to": "_other_to"})
    shared = F.least("_to", "_other_to") - F.greatest("_from", "_other_from")
    pairs = left.join(right, [*keys, "_bin"]).withColumn("_shared", shared).where("_shared > 0")
    sums = pairs.groupBy(
        *keys, F.col("_start").alias("interval_start"), F.col("_minutes").alias("interval_minutes")
    ).agg(F.sum("_shared").alias("_shared"), F.sum(F.col("_shared") * F.col("_v")).alias("_sum"))
    return rows.join(sums, interval, "left").select(
        *rows.columns,
        (F.col("_sum") / F.col("_shared")).alias("other_value"),
        (F.coalesce("_shared", F.lit(0)) / 60.0).alias("shared_minutes"),
    )


def _binned(rows: DataFrame, step: int) -> DataFrame:
    """One row per bin of ``step`` seconds that an interval touches, with its part of the interval."""
    begin = F.unix_micros("interval_start") / F.lit(1_000_000.0)
    rows = rows.withColumn("_begin", begin).withColumn("_end", F.col("_begin") + F.col("interval_minutes") * 60)
    rows = rows.where("_end > _begin").withColumn(
        "_bin", F.expr(f"explode(sequence(CAST(floor(_begin / {step}) AS BIGINT), CAST(ceil(_end / {step}) AS BIGINT) - 1))")
    )
    return rows.select(
        *[c for c in rows.columns if c not in ("_begin", "_end", "interval_start", "interval_minutes")],
        F.expr(f"greatest(_begin, _bin * {step})").alias("_from"),
        F.expr(f"least(_end, (_bin + 1) * {step})").alias("_to"),
    )
