"""Column expressions shared by the operators. All of them run JVM-side."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from hindcast.contract import STAMP_FORMAT


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)


def parse_stamp(text: Column) -> Column:
    return F.to_timestamp(text, "yyyyMMdd'T'HHmmssX")


def instant(ts: datetime) -> Column:
    """A driver-side aware datetime as a timestamp literal that pushes down to Parquet."""
    return F.timestamp_micros(F.lit(micros(ts)))


def micros(ts: datetime) -> int:
    if ts.tzinfo is None or ts.utcoffset() is None:
        raise ValueError(f"a stamp must be timezone-aware, got {ts!r}")
    whole = int(ts.replace(microsecond=0).timestamp())
    return whole * 1_000_000 + ts.microsecond


def series_name(variable: Column, zone: Column) -> Column:
    return F.concat_ws(":", variable, zone)


def variable_of(series: Column) -> Column:
    return F.substring_index(series, ":", 1)


def zone_of(series: Column) -> Column:
    return F.try_element_at(F.split(series, ":"), F.lit(2))


def finite(value: Column) -> Column:
    """True for a real number, false for null, NaN and the infinities."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def matches_series(series: Column, wanted: Sequence[str]) -> Column:
    """Exact names, or ``*`` wildcards; every other character stands for itself.

    What stands before the first wildcard is compared as a prefix, which Parquet scans use to skip
    row groups and pages; they could not use a pattern with escaped characters.
    """
    exact = [name for name in wanted if "*" not in name]
    test = series.isin(exact) if exact else F.lit(False)
    for name in wanted:
        if "*" in name:
            test = test | _matches(series, name)
    return test


def _matches(series: Column, name: str) -> Column:
    prefix, _, rest = name.partition("*")
    begins = series.startswith(prefix)
    return begins & series.like(like_pattern(name)) if rest else begins


def like_pattern(name: str) -> str:
    literal = "".join("\\" + ch if ch in "\\%_" else ch for ch in name)
    return literal.replace("*", "%")


def age_minutes(posted_at: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(posted_at)) / F.lit(60e6)


def lead_minutes(interval_start: Column, posted_at: Column) -> Column:
    return (F.unix_micros(interval_start) - F.unix_micros(posted_at)) / F.lit(60e6)


def slice_start(ts: Column, seconds: int) -> Column:
    """The start of the fixed-width time slice a stamp falls into."""
    at = F.unix_seconds(ts)
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds)))


def backfill_posted_at(interval_start: Column, days: Column, lag_minutes: Column) -> Column:
    """When a value predicted ``days`` x 24 h ahead was certainly known."""
    shift = lag_minutes.cast("long") * 60 - days.cast("long") * 86400
    return F.timestamp_micros(F.unix_micros(interval_start) + shift * 1_000_000)
