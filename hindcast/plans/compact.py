"""Compaction: merge the small files of a valid day without changing any answer."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.contract import FORECAST
from hindcast.functions.columns import instant
from hindcast.operators.checks import any_null
from hindcast.session import Scratch
from hindcast.settings import frame
from hindcast.sources import storage
from hindcast.sources.conformance import off_contract
from hindcast.sources.lake import Lake, older_than

MIN_AGE_MINUTES = 60
#: Day folders worked on together, and units deleted at once.
FOLDERS = 256
DELETES = 16
PARTITION = ("product", "date")
UNIT = ("product", "date", "posting")
SORT = ("product", "date", "interval_start", "series", "posted_at", "ingested_at")
MERGEABLE = r"^((part|merged)-\d{8}T\d{6}Z|previous-runs|batch-.+)$"

Partition = tuple[str, date]


@dataclass(frozen=True)
class Compaction:
    """What a run did: per partition the outcome (``merged``, or ``skipped`` as off the
    contract), units, leftover units and rows."""

    partitions: DataFrame
    stopped: bool  # there was more to do than this run's bound

    def by_product(self) -> DataFrame:
        merged = F.col("outcome") == "merged"
        return self.partitions.groupBy("product").agg(
            F.count_if(merged).alias("partitions_merged"),
            F.sum(F.when(merged, F.col("units"))).alias("units_in"),
            F.sum(F.when(merged, F.col("rows"))).alias("rows"),
            F.sum(F.when(merged, F.col("leftovers"))).alias("leftovers_removed"),
            F.array_sort(F.collect_list(F.when(~merged, F.col("date")))).alias("skipped"),
        )


def compact(
    lake: Lake,
    *,
    now: datetime,
    min_age_minutes: int = MIN_AGE_MINUTES,
    max_partitions: int | None = None,
    target_bytes: int = 256 * 1024 * 1024,
    delete_sources: bool = True,
) -> Compaction:
    """Merge partitions that hold two or more old enough units, oldest day first.

    The merged unit is written and compared with its sources, row by row, before any source is
    deleted. A record in ``compactions/`` says which units :meth:`Lake.curated` leaves out: first the
    merged ones, then, from one moment to the next, their sources instead, until these are gone. So
    every read, of versions too, sees each row once, and a run that dies at any point leaves a lake
    that reads as before; the next run clears up after it. With ``delete_sources=False`` it is left to
    the next run to delete them, so that reads that have begun can end.

    Units an earlier writer without such records merged but did not get to delete are recognised by
    their rows. Partitions with a file off the contract, or a null where none may be, are left alone
    and reported.

    Work goes on day folder by day folder, ``FOLDERS`` at a time, first those of this package's own
    layout, then flat ones, so the driver lists the files of so many and keeps one row of counts per
    merged partition. Only a caller that passes ``max_partitions`` bounds a run; the next one goes on
    where it stopped. One run at a time may work on a lake.

    In the flat layout a partition becomes one file, or several of about ``target_bytes``, named a
    second apart; such files are only merged again together with new ones.
    """
    target = f"merged-{now.astimezone(UTC):%Y%m%dT%H%M%SZ}"
    instant(now)  # refuses a naive stamp even if there is nothing to merge
    outcomes: list[dict] = []
    clear_up(lake)
    for layout in (OWN, FLAT):
        folders = lake.day_folders(flat=layout is FLAT)
        for k in range(0, len(folders), FOLDERS):
            most = None if max_partitions is None else max_partitions - len(outcomes)
            some = [folder for _, _, folder in folders[k : k + FOLDERS]]
            record = f"{target}-{layout.name}-{k}.json"
            with Scratch(lake.spark, "compact") as scratch:
                done, more = _compact_some(
                    lake, scratch, layout, some, target, record, now, min_age_minutes, most,
                    target_bytes, delete_sources,
                )
            outcomes += done
            if more:
                return Compaction(_outcomes(lake, outcomes), True)
    return Compaction(_outcomes(lake, outcomes), False)


@dataclass(frozen=True)
class _Layout:
    """Where the files of a partition and its units lie, and how their rows are read."""

    name: str

    def folder(self, lake: Lake, partition: Partition) -> str:
        product = partition[0] if self.name == "flat" else f"product={partition[0]}"
        return lake.path("curated", product, f"date={partition[1]}")

    def unit(self, lake: Lake, unit: tuple[str, date, str]) -> str:
        last = f"{unit[2]}.parquet" if self.name == "flat" else f"posting={unit[2]}"
        return f"{self.folder(lake, unit[:2])}/{last}"

    def rows(self, lake: Lake, partitions: list[Partition]) -> DataFrame:
        folders = [self.folder(lake, p) for p in partitions]
        if self.name == "flat":
            return lake.flat_days(folders)
        return lake.own_days(folders).withColumn("_row", F.col("_metadata.row_index"))


OWN, FLAT = _Layout("own"), _Layout("flat")


def clear_up(lake: Lake) -> None:
    """Delete the units that records of compactions hide, then empty the records; those that are
    empty already, and so have been seen by every read since, go."""
    for name, length, _ in storage.states(lake.spark, lake.path("compactions")):
        if length:
            _delete_hidden(lake, name)
        else:
            storage.delete_below(
                lake.spark, lake.path("compactions", name), guard=lake.path("compactions")
            )


def _hide(lake: Lake, record: str, layout: _Layout, units: list[tuple[str, date, str]]) -> None:
    """From now on reads leave out these units, and none that the record named before."""
    lines = [
        json.dumps({"product": p, "date": str(d), "posting": u, "layout": layout.name}) for p, d, u in units
    ]
    storage.replace_text(lake.spark, lake.path("compactions", record), "\n".join(lines))


def _delete_hidden(lake: Lake, record: str) -> None:
    for layout in (OWN, FLAT):
        units = [u for u in lake.hidden_units([record]) if u["layout"] == layout.name]
        _delete(lake, layout, [(u["product"], u["date"], u["posting"]) for u in units])
    storage.replace_text(lake.spark, lake.path("compactions", record), "")


def _compact_some(
    lake: Lake, scratch: Scratch, layout: _Layout, folders: list[str], target: str, record: str,
    now: datetime, min_age_minutes: int, most: int | None, target_bytes: int, delete_sources: bool,
) -> tuple[list[dict], bool]:
    """Outcomes of some day folders, and whether more was due than ``most``."""
    listing = scratch.keep(_units_to_merge(lake, layout, folders, now, min_age_minutes))
    due = (
        listing.groupBy(*PARTITION)
        .agg(
            F.count_distinct("posting").alias("units"),
            F.sum("length").alias("bytes"),
            F.bool_or(F.col("posting") == target).alias("clash"),
            F.count_if(~F.col("posting").startswith("merged-")).alias("unmerged"),
        )
        .where((F.col("units") >= 2) & ((F.col("unmerged") > 0) | (F.col("bytes") <= target_bytes)))
        .orderBy("date", "product")
        .collect()  # no more than the folders
    )
    more = most is not None and len(due) > most
    due = due[:most] if more else due
    if not due:
        return [], more
    if any(p.clash for p in due):
        raise ValueError(f"{target} is already there; merge again a second later")

    chosen = [(p.product, p.date) for p in due]
    named = {layout.folder(lake, partition): partition for partition in chosen}
    skipped = {named[f] for f in off_contract(lake.spark, list(named))}
    readable = [p for p in chosen if p not in skipped]
    units = _only(listing, readable).select(*UNIT).distinct()
    facts = scratch.keep(_facts(lake, layout, units, readable))
    nulls = facts.where("nulls > 0").select(*PARTITION).distinct().collect()
    skipped |= {(p.product, p.date) for p in nulls}
    good = [p for p in chosen if p not in skipped]
    units = _only(units, good)
    leftovers = _leftovers(lake, layout, _only(facts, good), scratch)
    sources = units.join(leftovers, [*UNIT], "left_anti")

    rows: dict[Partition, int] = {}
    if good:
        sizes = {(p.product, p.date): p.bytes for p in due if (p.product, p.date) in good}
        if layout is FLAT:
            names = {p: _names(now, -(-size // target_bytes)) for p, size in sizes.items()}
        else:
            names = {p: [target] for p in sizes}
        merged = [(*p, name) for p, some in names.items() for name in some]
        _hide(lake, record, layout, merged)
        if layout is FLAT:
            _merge_flat(lake, sources, names)
        else:
            _merge(lake, sources, good, target, max(len(good), -(-sum(sizes.values()) // target_bytes)))
        rows = _checked(lake, layout, sources, merged, good)
        _hide(lake, record, layout, [tuple(u) for u in units.select(*UNIT).collect()])
        if delete_sources:
            _delete_hidden(lake, record)
    left = {
        (p.product, p.date): p["count"] for p in leftovers.groupBy(*PARTITION).count().collect()
    }
    return [
        {
            "product": p.product,
            "date": p.date,
            "outcome": "skipped" if (p.product, p.date) in skipped else "merged",
            "units": p.units,
            "leftovers": left.get((p.product, p.date), 0),
            "rows": rows.get((p.product, p.date)),
        }
        for p in due
    ], more


def _names(now: datetime, many: int) -> list[str]:
    return [f"merged-{now.astimezone(UTC) + timedelta(seconds=k):%Y%m%dT%H%M%SZ}" for k in range(max(many, 1))]


def _delete(lake: Lake, layout: _Layout, units: list[tuple[str, date, str]]) -> None:
    """Remove units, several at a time: most of the time goes into waiting for the store."""

    def remove(unit: tuple[str, date, str]) -> None:
        storage.delete_below(lake.spark, layout.unit(lake, unit), guard=lake.path("curated"))

    with ThreadPoolExecutor(DELETES) as pool:
        list(pool.map(remove, units))


def _facts(lake: Lake, layout: _Layout, units: DataFrame, partitions: list[Partition]) -> DataFrame:
    """Per unit, from one scan: rows with a null where none may be, and when they were ingested."""
    if not partitions:
        return units.select(*UNIT, *[F.lit(0).cast("long").alias(c) for c in ("nulls", "first", "last")])
    rows = _rows(lake, layout, units, partitions)
    return rows.groupBy(*UNIT).agg(
        F.count_if(any_null(FORECAST.fieldNames())).alias("nulls"),
        F.min(F.unix_micros("ingested_at")).alias("first"),
        F.max(F.unix_micros("ingested_at")).alias("last"),
    )


def _units_to_merge(
    lake: Lake, layout: _Layout, folders: list[str], now: datetime, min_age_minutes: int
) -> DataFrame:
    """Files of units none of whose files may still be in the making."""
    files = lake.curated_files(folders).where(F.col("own") == F.lit(layout is OWN))
    files = files.where(F.col("posting").rlike(MERGEABLE))
    newest = files.groupBy(*UNIT).agg(F.max("modified_at").alias("modified_at"))
    return files.drop("own").join(
        older_than(newest, now, min_age_minutes).select(*UNIT), [*UNIT], "left_semi"
    )


def _leftovers(lake: Lake, layout: _Layout, units: DataFrame, scratch: Scratch) -> DataFrame:
    """Units whose every row, with multiplicity, is in the partition's newest merged unit.

    Units ingested wholly after the merged one are ruled out by that, which in the normal case is
    all of them. What remains is compared by content, and all of a partition's
    leftovers must fit into the merged unit together.
    """
    merged = (
        units.where(F.col("posting").startswith("merged-"))
        .groupBy(*PARTITION)
        .agg(F.max_by(F.struct("posting", "last"), "posting").alias("held"))
    )
    possible = F.coalesce(F.col("first") <= F.col("held.last"), F.lit(True))
    suspects = units.join(merged, [*PARTITION]).where(
        (F.col("posting") != F.col("held.posting")) & possible
    )
    suspects = scratch.keep(suspects)
    held_units = suspects.select(*PARTITION, F.col("held.posting").alias("posting")).distinct()
    partitions = [(p.product, p.date) for p in held_units.collect()]
    if not partitions:
        return suspects.select(*UNIT)
    columns = [*PARTITION, *FORECAST.fieldNames()]
    held = (
        _rows(lake, layout, held_units, partitions).groupBy(*columns).agg(F.count("*").alias("_held"))
    )
    found = (
        _rows(lake, layout, suspects.select(*UNIT), partitions)
        .groupBy(*columns, "posting")
        .agg(F.count("*").alias("_n"))
        .join(held, columns, "left")
        .withColumn("_held", F.coalesce("_held", F.lit(0)))
    )
    found = scratch.keep(found)
    alone = (
        found.groupBy(*UNIT)
        .agg(F.bool_and(F.col("_n") <= F.col("_held")).alias("_fits"))
        .where("_fits")
        .select(*UNIT)
    )
    too_many = (
        found.join(alone, [*UNIT], "left_semi")
        .groupBy(*columns)
        .agg(F.sum("_n").alias("_n"), F.first("_held").alias("_held"))
        .where("_n > _held")
        .select(*PARTITION)
        .distinct()
    )
    return scratch.keep(alone.join(too_many, [*PARTITION], "left_anti"))


def _merge(
    lake: Lake, sources: DataFrame, partitions: list[Partition], target: str, ranges: int
) -> None:
    """Write the sources' rows sorted by key. Ranges of the sort order make even files whatever
    a partition's size; the row number splits even a run of equal rows."""
    rows = _rows(lake, OWN, sources, partitions).withColumn("_salt", F.col("_row") % 1024)
    lake.write_postings(
        rows.repartitionByRange(ranges, *SORT, "_salt")
        .sortWithinPartitions(*SORT)
        .withColumn("posting", F.lit(target))
    )


def _merge_flat(lake: Lake, sources: DataFrame, names: dict[Partition, list[str]]) -> None:
    """Write each partition's rows as its files, sorted by key; several share the keys by hash."""
    rows = _rows(lake, FLAT, sources, list(names))
    shape = "array<struct<product: string, date: date, names: array<string>>>"
    listed = [{"product": p, "date": d, "names": some} for (p, d), some in names.items()]
    # Broadcast: a row per partition of this lot.
    rows = rows.join(F.broadcast(frame(lake.spark, listed, shape)), [*PARTITION])
    lot = "pmod(xxhash64(interval_start, series, posted_at, _row), size(names))"
    lake.write_flat(rows.withColumn("posting", F.expr(f"names[CAST({lot} AS INT)]")))


def _rows(lake: Lake, layout: _Layout, units: DataFrame, partitions: list[Partition]) -> DataFrame:
    """The rows of the given units, all of which lie in the given partitions; only those days'
    folders are listed."""
    table = layout.rows(lake, partitions)
    return table.join(units.select(*UNIT).distinct(), [*UNIT], "left_semi")


def _only(rows: DataFrame, partitions: list[Partition]) -> DataFrame:
    keys = [f"{product} {day}" for product, day in partitions]
    return rows.where(F.concat_ws(" ", *PARTITION).isin(keys))


def _checked(
    lake: Lake, layout: _Layout, sources: DataFrame, merged: list[tuple[str, date, str]],
    partitions: list[Partition],
) -> dict[Partition, int]:
    """Rows per merged partition, once each is shown to hold exactly its sources' rows, with
    multiplicity: every distinct row is counted on both sides."""
    shape = "array<struct<product: string, date: date, posting: string>>"
    listed = [{"product": p, "date": d, "posting": u} for p, d, u in merged]
    written = frame(lake.spark, listed, shape)
    both = sources.select(*UNIT, F.lit(False).alias("after")).unionByName(
        written.withColumn("after", F.lit(True))
    )
    balance = (
        layout.rows(lake, partitions)
        .join(both, [*UNIT])
        .groupBy(*PARTITION, *FORECAST.fieldNames())
        .agg(F.count_if("after").alias("after"), F.count_if(~F.col("after")).alias("before"))
    )
    sides = balance.groupBy(*PARTITION).agg(
        F.sum("after").alias("rows"), F.count_if(F.col("after") != F.col("before")).alias("wrong")
    ).collect()
    wrong = sorted((s.product, s.date) for s in sides if s.wrong)
    if wrong:
        raise RuntimeError(f"merged rows differ from their sources in {wrong[0]}; nothing deleted")
    return {(s.product, s.date): s.rows for s in sides}


def _outcomes(lake: Lake, rows: list[dict]) -> DataFrame:
    shape = (
        "array<struct<product: string, date: date, outcome: string, units: bigint, "
        "leftovers: bigint, rows: bigint>>"
    )
    return frame(lake.spark, rows, shape)
