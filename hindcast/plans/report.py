"""What a lake says about itself: manifests, coverage and freshness."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.contract import LIVE, PREVIOUS_RUNS, SCHEMA_VERSION
from hindcast.errors import QuarantinedError
from hindcast.functions.columns import instant
from hindcast.operators.calendar import latest_windows, window_plan
from hindcast.operators.changes import freshness, latest_manifest, one_per_poll
from hindcast.settings import Product, frame
from hindcast.sources import storage
from hindcast.sources.lake import Lake


def backfill_windows(
    lake: Lake, product: Product, first: date, last: date, *, now: datetime
) -> DataFrame:
    """The windows to request for a product's valid days, or an error if they make no sense."""
    rules = product.backfill
    if rules is None:
        raise ValueError(f"{product.key} declares no backfill")
    if not rules.earliest <= first <= last:
        raise ValueError(f"{first} to {last} is empty or starts before {rules.earliest}")
    if last > now.date():
        raise ValueError(f"{last} has not happened yet")
    row = {"product": product.key, "first": first, "last": last, "size": rules.window_days}
    shape = "array<struct<product: string, first: date, last: date, size: int>>"
    return window_plan(frame(lake.spark, [row], shape))


def manifests(lake: Lake, products: Sequence[Product]) -> DataFrame:
    """The newest posting of each product, as its manifest states it."""
    models = frame(
        lake.spark,
        [{"product": p.key, "model": p.model} for p in products],
        "array<struct<product: string, model: string>>",
    )
    newest = latest_manifest(one_per_poll(lake.polls()))
    return newest.join(models, "product", "left").withColumn(
        "schema_version", F.lit(SCHEMA_VERSION)
    )


def batch_summary(lake: Lake, batch: str) -> DataFrame:
    """What a batch did, per product and kind: ``responses``, ``postings`` (new ones, those it
    revived included), ``unchanged`` (polls that brought nothing new), ``rows``, ``dropped``,
    ``days``, ``quarantined``. Read from the logs, so it can be asked at any time."""
    polls = lake.polls().where(F.col("batch").isin(batch, f"{batch}-revived"))
    new = F.col("new_posting")
    own = F.col("batch") == batch
    live = polls.groupBy("product", F.lit(LIVE).alias("kind")).agg(
        F.count_if(own).alias("responses"),
        F.count_if(new).alias("postings"),
        F.count_if(~new).alias("unchanged"),
        F.sum(F.when(new, F.col("rows")).otherwise(0)).alias("rows"),
        F.sum(F.when(new, F.col("dropped")).otherwise(0)).alias("dropped"),
        F.collect_set(F.when(new, F.col("partitions"))).alias("_days"),
    )
    windows = lake.windows().where(own)
    past = windows.groupBy("product", F.lit(PREVIOUS_RUNS).alias("kind")).agg(
        F.count("*").alias("responses"),
        F.lit(0).cast("long").alias("postings"),
        F.lit(0).cast("long").alias("unchanged"),
        F.sum("rows").alias("rows"),
        F.sum("dropped").alias("dropped"),
        F.collect_set("days").alias("_days"),
    )
    done = live.unionByName(past)
    done = done.withColumn("days", F.size(F.array_distinct(F.flatten("_days")))).drop("_days")
    bad = quarantined(lake, batch).groupBy("product", "kind").agg(F.count("*").alias("quarantined"))
    both = done.join(bad, ["product", "kind"], "full")
    numbers = ("responses", "postings", "unchanged", "rows", "dropped", "days", "quarantined")
    return both.select(
        "product", "kind", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers]
    )


def quarantined(lake: Lake, batch: str | None = None) -> DataFrame:
    """Responses refused and why, of one batch or of all."""
    found = lake.quarantine()
    if batch is not None:
        found = found.where(F.col("batch").isin(f"{batch}-{LIVE}", f"{batch}-{PREVIOUS_RUNS}"))
    return found.drop("batch")


def raise_if_quarantined(bad: DataFrame, shown: int = 20) -> None:
    """Fail a run that refused responses, after everything else of it is done."""
    rows = bad.orderBy("product", "fetched_at", "problem").limit(shown + 1).collect()
    if rows:
        causes = "; ".join(f"{r.product} {r.raw_key}: {r.problem}" for r in rows[:shown])
        more = " and more" if len(rows) > shown else ""
        batches = tuple(sorted(r.batch for r in bad.select("batch").distinct().collect()))
        raise QuarantinedError(f"responses not as declared: {causes}{more}", batches)


def coverage(lake: Lake) -> DataFrame:
    """The newest fetch of each backfilled window."""
    return latest_windows(lake.windows())


def publish_manifests(lake: Lake, products: Sequence[Product]) -> None:
    """Write ``latest.json`` and ``previous_runs.json`` for readers that look for files. Each is
    one small document per product, made from one row, and takes the place of the one before at
    once: a reader gets either whole."""
    utc = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    options = {"timestampFormat": utc}
    newest = manifests(lake, products)
    rows = newest.select("product", F.to_json(F.struct("*"), options).alias("doc"))
    for row in rows.toLocalIterator():
        _write(lake, row.product, "latest.json", json.loads(row.doc))
    window = F.struct("fetched_at", "rows", "dropped")
    name = F.concat_ws("_", "first", "last")
    covered = coverage(lake).groupBy("product").agg(
        F.map_from_entries(F.collect_list(F.struct(name, window))).alias("windows")
    )
    rows = covered.select("product", F.to_json(F.struct("windows"), options).alias("doc"))
    for row in rows.toLocalIterator():
        _write(lake, row.product, "previous_runs.json", json.loads(row.doc))


def _write(lake: Lake, product: str, name: str, doc: dict) -> None:
    text = json.dumps(doc, indent=2, sort_keys=True) + "\n"
    storage.replace_text(lake.spark, lake.path("manifests", product, name), text)


def freshness_report(lake: Lake, products: Sequence[Product], now: datetime) -> DataFrame:
    """Per product, minutes since its newest live posting and whether that is too long. A
    product never posted has no age and counts as stale."""
    limits = frame(
        lake.spark,
        [{"product": p.key, "stale_after_min": p.stale_after_min} for p in products],
        "array<struct<product: string, stale_after_min: double>>",
    )
    posted = one_per_poll(lake.polls()).where("new_posting").select(
        "product", F.col("fetched_at").alias("posted_at")
    )
    ages = freshness(posted, now, stale_after_min=0.0).drop("stale")
    late = F.col("age_minutes") > F.col("stale_after_min")
    return (
        limits.join(ages, "product", "left")
        .withColumn("stale", F.coalesce(late, F.lit(True)))
        .withColumn("checked_at", instant(now))
    )
