"""Backfill windows: which days to request, and which are still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_plan(requests: DataFrame) -> DataFrame:
    """Split each ``(product, first, last, size)`` into consecutive windows of ``size`` days."""
    step = F.make_dt_interval(days=F.col("size"))
    starts = requests.select(
        "product", "size", "last", F.explode(F.sequence("first", "last", step)).alias("first")
    )
    end = F.least(F.date_add("first", F.col("size") - 1), F.col("last"))
    return starts.select("product", "first", end.alias("last"))


def latest_windows(windows: DataFrame) -> DataFrame:
    """The coverage record: the newest fetch of each window."""
    return (
        windows.groupBy("product", "first", "last")
        .agg(F.max(F.struct("fetched_at", "rows", "dropped")).alias("w"))
        .select("product", "first", "last", "w.*")
    )


def days_of(windows: DataFrame) -> DataFrame:
    return windows.select("product", F.explode(F.sequence("first", "last")).alias("day"))


def coverage_gaps(requests: DataFrame, windows: DataFrame) -> DataFrame:
    """Requested days no recorded window covers."""
    covered = days_of(windows).distinct()
    return days_of(requests).distinct().join(covered, ["product", "day"], "left_anti")


def window_totals(windows: DataFrame) -> DataFrame:
    """What a backfill amounts to per product: windows, rows, dropped zone-hours and days."""
    covered = days_of(windows).distinct().groupBy("product").agg(F.count("*").alias("days"))
    sums = latest_windows(windows).groupBy("product").agg(
        F.count("*").alias("windows"), F.sum("rows").alias("rows"), F.sum("dropped").alias("dropped")
    )
    return sums.join(covered, "product")
