"""Jobs that turn raw responses into curated rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.contract import FORECAST, LIVE, PREVIOUS_RUNS
from hindcast.errors import BatchMixUpError, MissingBodyError
from hindcast.operators.changes import mark_changes, one_per_poll
from hindcast.operators.responses import forecast_rows, zone_values
from hindcast.plans.report import batch_summary
from hindcast.session import Scratch
from hindcast.settings import Product, layouts
from hindcast.sources.lake import Lake

#: Days of the poll log in which a product's poll before a batch is looked for first.
LOOK_BACK = 7
#: Rows in a file of a batch unit, about.
FILE_ROWS = 1_000_000
POLL_COLUMNS = (
    "digest", "rows", "dropped", "valid_from", "valid_to", "partitions", "raw_key",
)


def curate_live(
    lake: Lake,
    products: Sequence[Product],
    responses: DataFrame,
    batch: str,
    *,
    kept: Callable[[Sequence[date]], DataFrame] | None = None,
    unit: str = "posting",
) -> DataFrame:
    """Publish the polls of a batch that changed something, log every poll, and say what was done
    (:func:`hindcast.plans.report.batch_summary`).

    Bodies are parsed once, into a table of small arrays that the quarantine, the poll log and
    the curated rows are all read from. Curated rows are written before the log, and both
    replace what an earlier attempt at the same batch wrote, so a batch can be repeated. A batch
    name that was used for other responses is refused.

    A poll older than ones already logged is fitted in by fetch time. If that turns a poll
    that was suppressed into a change, it is published now, its body read again from ``kept``,
    which gives the responses fetched on the days asked for; by default those the lake keeps. If
    a body is not there the batch fails before anything of it is logged: the log never calls a
    poll a posting whose rows were not written.

    ``unit="posting"`` writes one folder per posting and valid day; ``"batch"`` writes one per
    batch and day, for loads where the former would mean a flood of tiny files.
    """
    with Scratch(lake.spark, "curate") as scratch:
        expected = layouts(lake.spark, products, LIVE)
        values = scratch.keep(_numbered(zone_values(responses, expected, LIVE)))
        if values.isEmpty():
            return batch_summary(lake, batch)
        fresh = values.where("problem IS NULL").withColumnRenamed("days", "partitions")
        fresh = one_per_poll(
            fresh.select(
                "product", "fetched_at", F.lit(False).alias("new_posting"), *POLL_COLUMNS, "copy"
            )
        )
        _refuse_mix_up(lake.polls().where(F.col("batch") == batch), fresh, batch)
        _quarantine(lake, values, LIVE, batch)
        marked = scratch.keep(_with_history(fresh, lake, batch))

        new = marked.where("changed AND (fresh OR NOT new_posting)")
        lake.write_postings(_published(values, new.where("fresh"), unit, batch))
        revived = new.where(~F.col("fresh"))
        if not revived.isEmpty():
            _revive(lake, scratch, expected, revived, kept or lake.kept_responses, unit, batch)

        columns = ("product", "fetched_at", "new_posting", *POLL_COLUMNS)
        log = marked.withColumn("new_posting", F.col("changed"))
        lake.log_polls(log.where("fresh").select(*columns), batch)
        lake.log_polls(revived.withColumn("new_posting", F.lit(True)).select(*columns), _late(batch))
    return batch_summary(lake, batch)


def _late(batch: str) -> str:
    return f"{batch}-revived"


def _refuse_mix_up(logged: DataFrame, fresh: DataFrame, batch: str) -> None:
    """A batch repeated after a failure holds the polls its log holds, or the log is another's."""
    others = logged.join(fresh, ["product", "fetched_at"], "left_anti")
    if not others.isEmpty():
        raise BatchMixUpError(f"batch {batch} is logged with other responses")


def _revive(
    lake: Lake, scratch: Scratch, expected: DataFrame, revived: DataFrame,
    kept: Callable[[Sequence[date]], DataFrame], unit: str, batch: str,
) -> None:
    """Publish polls that were suppressed until a late one came in between."""
    polls = ["product", "fetched_at"]
    days = revived.select(F.to_date("fetched_at").alias("date")).distinct().collect()
    again = kept([d.date for d in days]).where(F.col("kind") == LIVE)
    again = again.join(revived.select(*polls), polls, "left_semi")
    reread = scratch.keep(_numbered(zone_values(again, expected, LIVE)).where("problem IS NULL"))
    one = reread.groupBy(*polls).agg(F.max("copy").alias("copy"))
    lost = revived.join(one, polls, "left_anti").select(*polls).limit(5).collect()
    if lost:
        named = ", ".join(f"{r.product} {r.fetched_at}" for r in lost)
        raise MissingBodyError(f"a late poll makes these postings, but no body is kept: {named}")
    lake.write_postings(_published(reread, one, unit, _late(batch)))


def _numbered(values: DataFrame) -> DataFrame:
    """Tell responses apart that were landed more than once: one ``copy`` of each is used."""
    return values.withColumn("copy", F.monotonically_increasing_id())


def _with_history(fresh: DataFrame, lake: Lake, batch: str) -> DataFrame:
    """The batch's polls and the logged ones they bear on, marked ``changed`` and ``fresh``.

    Of the log only polls from the batch's first fetch time on matter, and the last one before, so
    only those days of the log are read: from the batch's first day on, and of earlier days the
    last few, or more if that leaves a product without a poll before.
    """
    since = fresh.groupBy("product").agg(F.min("fetched_at").alias("_since"))
    start = fresh.agg(F.to_date(F.min("fetched_at"))).first()[0]
    if start is None:
        return mark_changes(fresh.withColumn("fresh", F.lit(True)))

    def logged(first: date | None, last: date | None) -> DataFrame:
        own = F.col("batch").isin(batch, _late(batch))
        found = one_per_poll(lake.polls(first, last).where(~own).drop("batch", "date"))
        found = found.select("product", "fetched_at", "new_posting", *POLL_COLUMNS)
        return found.join(since, "product").join(
            fresh.select("product", "fetched_at"), ["product", "fetched_at"], "left_anti"
        )

    def before(first: date | None) -> DataFrame:
        rest = ["new_posting", *POLL_COLUMNS]
        return (
            logged(first, start)
            .where("fetched_at < _since")
            .groupBy("product")
            .agg(F.max(F.struct("fetched_at", *rest)).alias("_p"))
            .select("product", "_p.*")
        )

    first = start - timedelta(days=LOOK_BACK)
    earlier = before(first)
    if lake.has_polls_before(first) and not since.join(earlier, "product", "left_anti").isEmpty():
        earlier = before(None)
    none = F.lit(None).cast("long").alias("copy")
    later = logged(start, None).where("fetched_at >= _since").drop("_since")
    timeline = (
        fresh.withColumns({"fresh": F.lit(True), "_seed": F.lit(False)})
        .unionByName(later.select("*", none).withColumns({"fresh": F.lit(False), "_seed": F.lit(False)}))
        .unionByName(earlier.select("*", none).withColumns({"fresh": F.lit(False), "_seed": F.lit(True)}))
    )
    return mark_changes(timeline).where("NOT _seed").drop("_seed")


def _published(values: DataFrame, polls: DataFrame, unit: str, batch: str) -> DataFrame:
    chosen = values.join(polls.select("copy"), "copy", "left_semi")
    rows = forecast_rows(chosen, LIVE)
    if unit == "posting":
        return rows
    if unit != "batch":
        raise ValueError(f"unit is 'posting' or 'batch', not {unit!r}")
    return _even(rows, f"batch-{batch}", chosen.agg(F.sum("rows")).first()[0] or 0)


def _even(rows: DataFrame, unit: str, many: int) -> DataFrame:
    """``many`` rows of one unit in key order, in files of even size whatever their keys, so that
    row groups cover few hours.

    The unit is named after the sort: Spark takes a constant out of a sort order, and would then
    sort again, by folder only.
    """
    order = ("product", "date", "interval_start", "series", "posted_at")
    files = max(-(-many // FILE_ROWS), 1)
    ranged = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return ranged.withColumn("posting", F.lit(unit))


def curate_previous_runs(
    lake: Lake, products: Sequence[Product], responses: DataFrame, batch: str
) -> DataFrame:
    """Write past vintages, one folder per valid day, log the windows they cover, and say what was
    done.

    The newest fetch of a day wins, within the batch and against the windows logged before: a day
    fetched again later replaces what was there, one fetched earlier is only logged.
    """
    with Scratch(lake.spark, "curate") as scratch:
        expected = layouts(lake.spark, products, PREVIOUS_RUNS)
        values = scratch.keep(_numbered(zone_values(responses, expected, PREVIOUS_RUNS)))
        if values.isEmpty():
            return batch_summary(lake, batch)
        good = values.where("problem IS NULL")
        logged = lake.windows()
        _refuse_mix_up(logged.where(F.col("batch") == batch), good, batch)
        _quarantine(lake, values, PREVIOUS_RUNS, batch)

        newest = (
            good.select("product", "fetched_at", "copy", F.explode("days").alias("date"))
            .groupBy("product", "date")
            .agg(F.max(F.struct("fetched_at", "copy")).alias("_n"))
        )
        there = (
            logged.where(F.col("batch") != batch)
            .select("product", "fetched_at", F.explode("days").alias("date"))
            .groupBy("product", "date")
            .agg(F.max("fetched_at").alias("_there"))
        )
        newest = newest.join(there, ["product", "date"], "left").where(
            F.coalesce(F.col("_n.fetched_at") >= F.col("_there"), F.lit(True))
        )
        newest = newest.select("product", "date", F.col("_n.copy").alias("copy"))
        rows = forecast_rows(good, PREVIOUS_RUNS, "copy")
        lake.write_postings(rows.join(newest, ["product", "date", "copy"]))
        lake.log_windows(
            good.select("product", "first", "last", "fetched_at", "rows", "dropped", "days"), batch
        )
    return batch_summary(lake, batch)


def _quarantine(lake: Lake, values: DataFrame, kind: str, batch: str) -> None:
    bad = values.where("problem IS NOT NULL").select(
        "product", F.lit(kind).alias("kind"), "fetched_at", "raw_key", "problem"
    )
    lake.log_quarantine(bad, f"{batch}-{kind}")


def land_forecast(lake: Lake, rows: DataFrame, unit: str) -> None:
    """Write rows that already are curated under one unit, split evenly whatever their keys."""
    placed = rows.select(
        "product", *FORECAST.fieldNames(), F.to_date("interval_start").alias("date")
    )
    lake.write_postings(_even(placed, unit, placed.count()))
