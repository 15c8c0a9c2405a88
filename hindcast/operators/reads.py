"""The two point-in-time reads. Both need a knowledge time; there is no read without one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.contract import (
    BUSINESS_KEY,
    POSTINGS_COLUMNS,
    SNAPSHOT_COLUMNS,
    SUPPORTED_SCHEMA_VERSIONS,
)
from hindcast.functions.columns import instant, matches_series

MAX_DAYS = 62
#: The newest version of a key is the greatest in these columns, the first of them first. Only the
#: clocks are the contract's rule; the others settle ties, so that reruns and all reads agree.
NEWEST = ("posted_at", "ingested_at", "source", "value")


def valid_days(
    start: datetime, end: datetime, as_of: datetime, max_days: int | None
) -> tuple[date, date]:
    """First and last UTC day of ``[start, end)``, after checking the arguments."""
    for name, ts in (("start", start), ("end", end), ("as_of", as_of)):
        if ts.tzinfo is None or ts.utcoffset() is None:
            raise ValueError(f"{name} must be timezone-aware, got {ts!r}")
    if not start < end:
        raise ValueError(f"empty interval range: {start} to {end}")
    first = start.astimezone(UTC).date()
    last = (end.astimezone(UTC) - timedelta(microseconds=1)).date()
    if max_days is not None and (last - first).days + 1 > max_days:
        raise ValueError(f"{first} to {last} is longer than {max_days} days; read it in windows")
    return first, last


def visible(
    rows: DataFrame,
    start: datetime,
    end: datetime,
    *,
    as_of: datetime,
    series: Sequence[str] | None = None,
    sources: Sequence[str] | None = None,
    known_to_system_at: datetime | None = None,
    max_days: int | None = MAX_DAYS,
) -> DataFrame:
    """Rows valid in ``[start, end)`` and posted by ``as_of``, of every version.

    Where the table has a ``date`` partition column the matching day range is added, since
    Spark cannot derive it from ``interval_start``.
    """
    first, last = valid_days(start, end, as_of, max_days)
    if "date" in rows.columns:
        rows = rows.where(F.col("date").between(F.lit(first), F.lit(last)))
    rows = rows.where(
        (F.col("interval_start") >= instant(start))
        & (F.col("interval_start") < instant(end))
        & (F.col("posted_at") <= instant(as_of))
    )
    if series:
        rows = rows.where(matches_series(F.col("series"), series))
    if sources:
        rows = rows.where(F.col("source").isin(list(sources)))
    if known_to_system_at is not None:
        rows = rows.where(F.col("ingested_at") <= instant(known_to_system_at))
    return rows


def latest(rows: DataFrame, key: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """The newest version per key: greatest ``posted_at``, then greatest ``ingested_at``.

    Spark limits each map task to one row per key before the shuffle, so a key with very many
    versions costs one row per task.
    """
    order = [F.col(c).desc() for c in NEWEST]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def refuse_unknown_versions(rows: DataFrame) -> DataFrame:
    """Fail the query if a row of the result is at an unknown schema version.

    It is a filter because an unused check column would be pruned from the plan.
    """
    version = F.col("schema_version")
    message = F.concat(
        F.lit("UNSUPPORTED_SCHEMA_VERSION: rows at schema_version "),
        F.coalesce(version.cast("string"), F.lit("null")),
    )
    known = version.isin(list(SUPPORTED_SCHEMA_VERSIONS))
    return rows.where(F.assert_true(F.coalesce(known, F.lit(False)), message).isNull())


def snapshot(rows: DataFrame, start: datetime, end: datetime, **cuts) -> DataFrame:
    """What was forecast for ``[start, end)`` as known at ``as_of``, one row per key, in order.

    ``cuts`` are those of :func:`visible`.
    """
    newest = latest(visible(rows, start, end, **cuts), _key(rows))
    return _ordered(newest, SNAPSHOT_COLUMNS, _key(rows))


def postings(rows: DataFrame, start: datetime, end: datetime, **cuts) -> DataFrame:
    """Every version valid in ``[start, end)`` and posted by ``as_of``, oldest first per key."""
    every = visible(rows, start, end, **cuts)
    return _ordered(every, POSTINGS_COLUMNS, (*_key(rows), "posted_at"))


def _key(rows: DataFrame) -> tuple[str, ...]:
    """Products never mix: where a table holds several, the product is part of the key."""
    return ("product", *BUSINESS_KEY) if "product" in rows.columns else BUSINESS_KEY


def _ordered(rows: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    kept: list[str | Column] = ["product"] if "product" in rows.columns else []
    return refuse_unknown_versions(rows).select(*kept, *columns).orderBy(*order)
