import json
import os
import time
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import (
    AFTERNOON,
    HILLS,
    MORNING,
    SMALL,
    VALID,
    forecast,
    live_response,
    past_response,
    responses,
    row,
    two_postings,
    write_catalog,
)
from pyspark.sql import functions as F

from hindcast.errors import BusyError
from hindcast.operators import checks, reads
from hindcast.operators.calendar import (
    coverage_gaps,
    latest_windows,
    window_plan,
    window_totals,
)
from hindcast.operators.sets import excess, union_by_name
from hindcast.plans import catalog as catalogs
from hindcast.plans import report
from hindcast.plans.compact import compact
from hindcast.plans.curate import curate_live, curate_previous_runs
from hindcast.plans.verify import problems, verify_lake
from hindcast.settings import GFS_SEAMLESS
from hindcast.sources import storage
from hindcast.sources.lake import Lake

DAY = timedelta(days=1)
MIDNIGHT = datetime(2025, 6, 20, tzinfo=UTC)
LATER = datetime(2099, 1, 1, tzinfo=UTC)
SERIES = "temperature_2m:Bay"


def write(lake, unit, rows):
    df = forecast(lake.spark, rows).withColumn("product", F.lit(HILLS))
    lake.write_postings(
        df.withColumn("date", F.to_date("interval_start")).withColumn("posting", F.lit(unit))
    )


@pytest.fixture
def lake(spark, tmp_path):
    """Two live postings and a backfilled one of the same day; four rows in three units."""
    lake = Lake(spark, tmp_path)
    hour = timedelta(hours=1)
    write(lake, "part-20250620T021000Z", [row(VALID, SERIES, 1, MORNING), row(VALID + hour, SERIES, 2, MORNING)])
    write(lake, "part-20250620T144000Z", [row(VALID, SERIES, 1.5, AFTERNOON)])
    past = MORNING - DAY
    write(
        lake, "previous-runs",
        [row(VALID, SERIES, 0.5, past, ingested=MORNING, source="previous_runs")],
    )
    return lake


def answers(lake):
    rows = lake.curated([HILLS]).drop("product", "posting")
    moments = [MORNING - 2 * DAY, MORNING - timedelta(hours=1), MORNING, AFTERNOON]
    return [
        [tuple(r) for r in reads.snapshot(rows, MIDNIGHT, MIDNIGHT + DAY, as_of=at).collect()]
        for at in moments
    ]


def bag(lake):
    return sorted(tuple(r) for r in lake.curated([HILLS]).drop("posting").collect())


def units(lake):
    return sorted(r.posting for r in lake.curated_files().select("posting").distinct().collect())


def test_compaction_changes_no_answer(spark, lake):
    before, rows = answers(lake), bag(lake)
    done = compact(lake, now=LATER)
    assert answers(lake) == before and bag(lake) == rows
    assert units(lake) == ["merged-20990101T000000Z"]
    summary = done.by_product().collect()[0]
    assert (summary.partitions_merged, summary.units_in, summary.rows) == (1, 3, 4)
    assert (summary.leftovers_removed, summary.skipped, done.stopped) == (0, [], False)
    merged = lake.curated_files().collect()
    assert len(merged) == 1
    table = pq.read_table(merged[0].path.removeprefix("file:")).to_pydict()
    order = list(zip(table["interval_start"], table["series"], table["posted_at"], strict=True))
    assert order == sorted(order)
    again = compact(lake, now=LATER + DAY)
    assert again.partitions.count() == 0 and units(lake) == ["merged-20990101T000000Z"]


def test_young_units_are_left_alone(spark, lake):
    now = datetime.now(UTC)
    assert compact(lake, now=now).partitions.count() == 0
    old = time.time() - 7200
    for path in Path(lake.root).rglob("*.parquet"):
        if "part-" in str(path.parent):
            os.utime(path, (old, old))
    done = compact(lake, now=now)
    assert done.by_product().collect()[0].units_in == 2
    assert len(units(lake)) == 2 and "previous-runs" in units(lake)


def test_leftovers_of_a_dead_run_are_not_merged_twice(spark, lake):
    rows = bag(lake)
    compact(lake, now=LATER)
    hour = timedelta(hours=1)
    write(lake, "part-20250620T021000Z", [row(VALID, SERIES, 1, MORNING), row(VALID + hour, SERIES, 2, MORNING)])
    fresh = row(VALID, SERIES, 9, AFTERNOON + hour)
    write(lake, "part-20250620T154000Z", [fresh])
    late = row(VALID, SERIES, 0.7, MORNING - DAY, ingested=MORNING, source="previous_runs")
    write(lake, "previous-runs", [late])
    done = compact(lake, now=LATER + DAY).by_product().collect()[0]
    assert (done.units_in, done.leftovers_removed, done.rows) == (4, 1, 6)
    assert len(bag(lake)) == len(rows) + 2


def test_units_that_only_fit_one_by_one_are_all_kept(spark, lake):
    compact(lake, now=LATER)
    twice = [row(VALID, SERIES, 1.5, AFTERNOON)]
    write(lake, "part-20250620T144000Z", twice)
    write(lake, "part-20250620T144001Z", twice)
    done = compact(lake, now=LATER + DAY).by_product().collect()[0]
    assert (done.leftovers_removed, done.rows) == (0, 6)


def test_copies_inside_a_posting_survive(spark, lake):
    copies = [row(VALID, SERIES, 4, AFTERNOON + DAY)] * 5
    write(lake, "part-20250621T144000Z", copies)
    rows = bag(lake)
    compact(lake, now=LATER, target_bytes=500)
    assert bag(lake) == rows


def test_a_run_is_bounded_and_the_next_goes_on(spark, lake):
    for day in (1, 2):
        at = VALID + day * DAY
        write(lake, "part-20250620T021000Z", [row(at, SERIES, day, MORNING)])
        write(lake, "part-20250620T144000Z", [row(at, SERIES, day, AFTERNOON)])
    first = compact(lake, now=LATER, max_partitions=2)
    assert first.stopped
    assert [r.date for r in first.partitions.orderBy("date").collect()] == [
        date(2025, 6, 20), date(2025, 6, 21),
    ]
    second = compact(lake, now=LATER + DAY, max_partitions=2)
    assert not second.stopped and second.partitions.count() == 1


def _replace_file(lake, unit, change):
    path = next(Path(lake.root).rglob(f"posting={unit}/*.parquet"))
    # As another writer would leave it: Spark's own copy of the schema would hide the change.
    table = change(pq.read_table(path, partitioning=None)).replace_schema_metadata(None)
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    pq.write_table(table, path)


@pytest.mark.parametrize("how", ["type", "missing", "null", "null without statistics"])
def test_partitions_off_the_contract_are_skipped(spark, lake, how):
    def change(table):
        at = table.schema.get_field_index("value")
        if how == "type":
            return table.set_column(at, "value", table["value"].cast(pa.float32()))
        if how == "missing":
            return table.remove_column(at)
        return table.set_column(at, "value", pa.array([None] * table.num_rows, pa.float64()))

    _replace_file(lake, "part-20250620T144000Z", change)
    if how == "null without statistics":
        path = next(Path(lake.root).rglob("posting=part-20250620T144000Z/*.parquet"))
        pq.write_table(pq.read_table(path, partitioning=None), path, write_statistics=False)
    other = VALID + DAY
    write(lake, "part-20250620T021000Z", [row(other, SERIES, 1, MORNING)])
    write(lake, "part-20250620T144000Z", [row(other, SERIES, 2, AFTERNOON)])
    done = compact(lake, now=LATER).by_product().collect()[0]
    assert (done.partitions_merged, done.skipped) == (1, [date(2025, 6, 20)])
    left = lake.curated_files().where("date = DATE'2025-06-20'").select("posting").distinct()
    assert left.count() == 3


def test_a_nullable_flag_is_no_difference(spark, lake):
    strict = pa.schema(
        [pa.field("interval_start", pa.timestamp("us", tz="UTC"), False),
         pa.field("interval_minutes", pa.int32(), False),
         pa.field("posted_at", pa.timestamp("us", tz="UTC"), False),
         pa.field("ingested_at", pa.timestamp("us", tz="UTC"), False),
         pa.field("source", pa.string(), False), pa.field("schema_version", pa.int32(), False),
         pa.field("series", pa.string(), False), pa.field("value", pa.float64(), False)]
    )
    _replace_file(lake, "part-20250620T144000Z", lambda t: t.cast(strict))
    done = compact(lake, now=LATER).by_product().collect()[0]
    assert (done.partitions_merged, done.skipped) == (1, [])


def test_only_curated_units_can_be_deleted(spark, lake):
    guard = lake.path("curated")
    for uri in (lake.path("raw", "x"), guard, f"{guard}/", f"{guard}/../raw", "/"):
        with pytest.raises(ValueError, match="not below"):
            storage.delete_below(spark, uri, guard=guard)


def report_of(lake):
    return {r.check: (r.n, r.sample) for r in verify_lake(lake).collect()}


def test_a_sound_lake_verifies(spark, lake):
    write_catalog(lake.root)
    found = report_of(lake)
    assert found["rows"][0] == 4 and found["series"][0] == 1 and found["live_postings"][0] == 2
    assert problems(verify_lake(lake)).count() == 0


def test_broken_rules_are_counted(spark, lake):
    write_catalog(lake.root)
    rows = [row(VALID, f"odd{i}:Bay", 1, MORNING) for i in range(7)]
    rows += [row(VALID, SERIES, 1, MORNING + DAY, ingested=MORNING), row(VALID, SERIES, 1, AFTERNOON, version=9)]
    rows += [row(VALID, SERIES, 1, MORNING, source="previous_runs")]
    write(lake, "part-20250622T000000Z", rows)
    found = report_of(lake)
    assert found["series_not_in_catalog"] == (
        7, "odd0:Bay, odd1:Bay, odd2:Bay, odd3:Bay, odd4:Bay"
    )
    assert found["posted_after_ingested"][0] == 1
    assert found["unknown_schema_version"] == (1, "9")
    assert found["key_repeated_in_posting"][0] == 2
    assert found["key_repeated_in_posting_and_source"][0] == 1
    broken = {r.check for r in problems(verify_lake(lake)).collect()}
    assert broken == {
        "series_not_in_catalog", "posted_after_ingested", "unknown_schema_version",
        "key_repeated_in_posting_and_source",
    }


def test_missing_files_and_columns_stop_a_product(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    write_catalog(tmp_path)
    assert report_of(lake) == {"no_curated_files": (1, None), "missing_columns": (0, None)}
    write(lake, "part-20250620T021000Z", two_postings()[:1])
    _replace_file(lake, "part-20250620T021000Z", lambda t: t.drop_columns(["value", "source"]))
    found = report_of(lake)
    assert found["missing_columns"] == (2, "source, value") and "rows" not in found


def test_null_rows_are_counted(spark):
    rows = forecast(spark, two_postings()).withColumns(
        {"product": F.lit(HILLS), "value": F.when(F.col("value") > 9.5, F.col("value"))}
    )
    expected = spark.createDataFrame([(HILLS, SERIES)], "product string, series string")
    got = {r.check: r.n for r in checks.verify(rows, expected).collect()}
    assert got["null_in_required_column"] == 3 and got["series_not_in_catalog"] == 2


def test_catalog_is_published_only_when_it_changes(spark, tmp_path):
    root = str(tmp_path)
    assert catalogs.publish_catalog(spark, root, [GFS_SEAMLESS], MORNING)
    first = Path(catalogs.catalog_path(root)).read_text()
    assert not catalogs.publish_catalog(spark, root, [GFS_SEAMLESS], AFTERNOON)
    assert Path(catalogs.catalog_path(root)).read_text() == first
    doc = json.loads(first)
    entry = doc["products"][GFS_SEAMLESS.key]
    assert entry["variables"]["shortwave_radiation"] == "W/m²" and entry["live"] is True
    assert len(entry["zones"]["Coast"]) == 3 and doc["business_key"] == ["interval_start", "series"]
    catalog = catalogs.load_catalog(spark, root)
    tables = catalogs.entries(spark, catalog)
    assert catalogs.expected_series(tables).distinct().count() == 72
    assert catalogs.zone_points(tables).count() == 22
    assert catalogs.variables(tables).where("unit = 'm/s'").count() == 2


def test_a_vanished_product_stays_but_is_not_live(spark, tmp_path):
    root = str(tmp_path)
    write_catalog(root, "old-model")
    before = json.loads(Path(catalogs.catalog_path(root)).read_text())["products"]["old-model"]
    assert catalogs.publish_catalog(spark, root, [GFS_SEAMLESS], AFTERNOON)
    products = catalogs.load_catalog(spark, root).products
    assert {k: v["live"] for k, v in products.items()} == {"old-model": False, GFS_SEAMLESS.key: True}
    assert products["old-model"]["variables"] == before["variables"]
    assert not catalogs.publish_catalog(spark, root, [GFS_SEAMLESS], AFTERNOON)


def test_windows_cover_a_range_without_overlap(spark):
    requests = spark.createDataFrame(
        [("p", date(2024, 1, 1), date(2024, 1, 31), 14), ("q", date(2024, 1, 5), date(2024, 1, 5), 14)],
        "product string, first date, last date, size int",
    )
    got = [(r.product, r.first.day, r.last.day)
           for r in window_plan(requests).orderBy("product", "first").collect()]
    assert got == [("p", 1, 14), ("p", 15, 28), ("p", 29, 31), ("q", 5, 5)]


def test_coverage_and_gaps(spark):
    shape = "product string, first date, last date, fetched_at timestamp, rows long, dropped long"
    d = lambda n: date(2024, 1, n)
    windows = spark.createDataFrame(
        [("p", d(1), d(3), MORNING, 5, 0), ("p", d(1), d(3), AFTERNOON, 6, 1), ("p", d(6), d(7), MORNING, 1, 0)],
        shape,
    )
    newest = latest_windows(windows).orderBy("first").collect()
    assert [(r.rows, r.dropped) for r in newest] == [(6, 1), (1, 0)]
    asked = spark.createDataFrame([("p", d(1), d(8))], "product string, first date, last date")
    gaps = coverage_gaps(asked, windows).orderBy("day").collect()
    assert [r.day.day for r in gaps] == [4, 5, 8]


def test_backfill_requests_are_checked(spark, tmp_path):
    lake, d = Lake(spark, tmp_path), lambda n: date(2024, 1, n)
    got = report.backfill_windows(lake, GFS_SEAMLESS, d(1), d(31), now=MORNING)
    assert [r.first.day for r in got.orderBy("first").collect()] == [1, 15, 29]
    for first, last, now in (
        (date(2023, 12, 31), d(2), MORNING), (d(3), d(2), MORNING), (d(1), date(2025, 6, 21), MORNING),
    ):
        with pytest.raises(ValueError, match="2"):
            report.backfill_windows(lake, GFS_SEAMLESS, first, last, now=now)
    with pytest.raises(ValueError, match="no backfill"):
        report.backfill_windows(lake, replace(GFS_SEAMLESS, backfill=None), d(1), d(2), now=MORNING)


def test_manifests_and_freshness_of_a_lake(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    assert report.freshness_report(lake, [SMALL], MORNING).collect()[0].stale
    body = live_response(hours=2, product=SMALL)
    curate_live(lake, [SMALL], responses(spark, body, body, product="small"), "b0")
    day = date(2024, 3, 2)
    past = responses(
        spark, past_response(day, product=SMALL), product="small", kind="previous_runs",
        first=day, last=day,
    )
    curate_previous_runs(lake, [SMALL], past, "b0")
    got = report.freshness_report(lake, [SMALL], MORNING + timedelta(hours=5)).collect()[0]
    assert (got.age_minutes, got.stale) == (300.0, True)
    report.publish_manifests(lake, [SMALL])
    folder = Path(lake.root, "manifests", "small")
    latest = json.loads((folder / "latest.json").read_text())
    assert latest["last_posted_at"] == "2025-06-20T02:10:00Z"
    assert latest["last_checked_at"] == "2025-06-20T03:10:00Z"
    assert (latest["rows"], latest["model"], latest["partitions"]) == (8, "m", ["2025-06-20"])
    covered = json.loads((folder / "previous_runs.json").read_text())["windows"]
    assert covered["2024-03-02_2024-03-02"]["rows"] == 192
    assert lake.manifests().collect()[0].content_hash == latest["content_hash"]
    totals = window_totals(lake.windows()).collect()[0]
    assert (totals.windows, totals.rows, totals.dropped, totals.days) == (1, 192, 0, 1)


def test_bags_respect_multiplicity(spark):
    shape = "a int, b string"
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (2, None)], shape)
    right = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "z")], shape)
    assert [tuple(r) for r in excess(left, right).collect()] == [(1, "x", 1)]
    assert excess(right, left).collect()[0].a == 3
    wide = union_by_name(left, right.drop("b"))
    assert wide.where("b IS NULL").count() == 6


# -- compaction: flat layout, and reads while it runs ------------------------------------------


@pytest.fixture
def flat(spark, tmp_path):
    """The same four rows as files named after their posting, as another writer lays them out."""
    lake = Lake(spark, tmp_path)
    hour = timedelta(hours=1)
    units = {
        "part-20250620T021000Z": [row(VALID, SERIES, 1, MORNING), row(VALID + hour, SERIES, 2, MORNING)],
        "part-20250620T144000Z": [row(VALID, SERIES, 1.5, AFTERNOON)],
        "previous-runs": [row(VALID, SERIES, 0.5, MORNING - DAY, ingested=MORNING, source="previous_runs")],
    }
    for unit, rows in units.items():
        write_flat(lake, unit, rows)
    return lake


def write_flat(lake, unit, rows):
    df = forecast(lake.spark, rows).withColumn("product", F.lit(HILLS)).withColumn("posting", F.lit(unit))
    lake.write_flat(df.withColumn("date", F.to_date("interval_start")))


def flat_files(lake):
    return sorted(str(p.relative_to(lake.path("curated"))) for p in Path(lake.path("curated")).rglob("*.parquet"))


def test_flat_files_are_named_after_their_posting(flat):
    assert flat_files(flat) == [
        f"{HILLS}/date=2025-06-20/{u}.parquet"
        for u in ("part-20250620T021000Z", "part-20250620T144000Z", "previous-runs")
    ]
    write_flat(flat, "previous-runs", [row(VALID, SERIES, 7, MORNING - DAY, source="previous_runs")])
    assert len(flat_files(flat)) == 3 and flat.curated([HILLS]).where("value = 7").count() == 1
    assert not os.listdir(flat.path("_aside"))


def test_flat_lakes_are_compacted_to_one_file(spark, flat):
    before, rows = answers(flat), bag(flat)
    done = compact(flat, now=LATER).by_product().collect()[0]
    assert (done.partitions_merged, done.units_in, done.rows, done.leftovers_removed) == (1, 3, 4, 0)
    assert answers(flat) == before and bag(flat) == rows
    assert flat_files(flat) == [f"{HILLS}/date=2025-06-20/merged-20990101T000000Z.parquet"]
    table = pq.read_table(next(Path(flat.root).rglob("merged-*.parquet")), partitioning=None)
    order = list(zip(*(table[c].to_pylist() for c in ("interval_start", "series", "posted_at")), strict=True))
    assert order == sorted(order)
    write_flat(flat, "part-20250620T144000Z", [row(VALID, SERIES, 1.5, AFTERNOON)])  # a leftover
    write_flat(flat, "part-20250620T184000Z", [row(VALID, SERIES, 3, AFTERNOON + timedelta(hours=4))])
    done = compact(flat, now=LATER + DAY).by_product().collect()[0]
    assert (done.units_in, done.leftovers_removed, done.rows) == (3, 1, 5)
    assert len(bag(flat)) == 5 and len(flat_files(flat)) == 1


def test_large_flat_partitions_become_several_files_once(spark, flat):
    many = [row(VALID, f"s{k}:Bay", k, AFTERNOON) for k in range(300)]
    write_flat(flat, "part-20250620T144000Z", many)
    rows = bag(flat)
    size = sum(os.path.getsize(p) for p in Path(flat.path("curated")).rglob("*.parquet"))
    compact(flat, now=LATER, target_bytes=size // 3)
    names = flat_files(flat)
    assert len(names) in (3, 4) and all("/merged-2099" in n for n in names) and bag(flat) == rows
    assert compact(flat, now=LATER + DAY, target_bytes=200).partitions.count() == 0
    assert flat_files(flat) == names


@pytest.mark.parametrize("kind", ["lake", "flat"])
def test_versions_are_read_once_while_sources_wait(kind, request):
    lake = request.getfixturevalue(kind)
    before, rows = answers(lake), bag(lake)
    compact(lake, now=LATER, delete_sources=False)
    assert len(units(lake)) == 4  # three sources and what they became
    assert bag(lake) == rows and answers(lake) == before
    assert {r.posting for r in lake.curated().collect()} == {"merged-20990101T000000Z"}
    assert compact(lake, now=LATER + DAY).partitions.count() == 0
    assert lake.curated_files().count() == 1 and bag(lake) == rows
    compact(lake, now=LATER + DAY)
    assert not storage.states(lake.spark, lake.path("compactions"))


@pytest.mark.parametrize("kind", ["lake", "flat"])
@pytest.mark.parametrize("where", ["_checked", "_delete_hidden", "clear_up"])
def test_a_run_that_dies_changes_nothing(kind, where, request, monkeypatch):
    lake = request.getfixturevalue(kind)
    rows = bag(lake)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        if where == "clear_up":  # the run after one that died
            compact(lake, now=LATER, delete_sources=False)
        patched.setattr(f"hindcast.plans.compact.{where}", dies)
        with pytest.raises(OSError, match="lost"):
            compact(lake, now=LATER)
    assert bag(lake) == rows
    compact(lake, now=LATER + DAY)
    assert bag(lake) == rows and lake.curated_files().count() == 1


def test_a_listing_that_a_compaction_overtakes_is_repeated(lake, monkeypatch):
    rows, listed, real = bag(lake), [], Lake._listed

    def slow(self, *args):
        found = real(self, *args)
        if not listed:
            listed.append(1)
            compact(lake, now=LATER, delete_sources=False)
        return found

    monkeypatch.setattr(Lake, "_listed", slow)
    assert bag(lake) == rows
    assert {r.posting for r in lake.curated([HILLS]).collect()} == {"merged-20990101T000000Z"}


def test_both_layouts_of_a_product_are_compacted_apart(spark, lake):
    write_flat(lake, "part-20250620T021000Z", [row(VALID, "flat:Bay", 1, MORNING)])
    write_flat(lake, "part-20250620T144000Z", [row(VALID, "flat:Bay", 2, AFTERNOON)])
    rows = bag(lake)
    done = compact(lake, now=LATER).by_product().collect()[0]
    assert done.partitions_merged == 2 and bag(lake) == rows and lake.curated_files().count() == 2


# -- documents replaced as a whole ---------------------------------------------------------------


def test_a_writer_that_dies_leaves_the_old_document(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "doc.json")
    storage.replace_text(spark, uri, "old")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(storage, "move", dies)
        with pytest.raises(OSError, match="lost"):
            storage.replace_text(spark, uri, "new")
    assert storage.read_text(spark, uri) == "old"
    assert [name for name, _, _ in storage.states(spark, str(tmp_path))] == ["doc.json"]


def test_of_two_publishers_one_looks_again(spark, tmp_path, monkeypatch):
    second = replace(SMALL, key="second")
    real, calls = storage.publish, []

    def overtaken(spark, uri, seen, text, **how):
        calls.append(seen)
        if len(calls) == 1:  # another publisher is faster
            assert catalogs.publish_catalog(spark, str(tmp_path), [second], LATER)
        return real(spark, uri, seen, text, **how)

    monkeypatch.setattr(storage, "publish", overtaken)
    assert catalogs.publish_catalog(spark, str(tmp_path), [SMALL], LATER)
    assert len(calls) == 3 and calls[0] is None and calls[2] is not None
    assert set(catalogs.load_catalog(spark, str(tmp_path)).products) == {"second", "small"}


def test_publishers_exclude_each_other_but_not_for_ever(spark, tmp_path):
    uri, mark = str(tmp_path / "doc"), str(tmp_path / "_doc.writing")
    assert storage.create(spark, mark) and not storage.create(spark, mark)
    assert not storage.publish(spark, uri, None, "x")
    assert not storage.publish(spark, uri, None, "x", patience=-1)  # takes the mark away
    assert storage.publish(spark, uri, None, "x") and not storage.publish(spark, uri, None, "y")
    assert storage.publish(spark, uri, "x", "y") and storage.read_text(spark, uri) == "y"
    storage.create(spark, str(tmp_path / "manifests/__catalog.json.writing"))
    with pytest.raises(BusyError):
        catalogs.publish_catalog(spark, str(tmp_path), [SMALL], LATER, tries=2)


def test_remembered_days_give_the_same_report(spark, lake, monkeypatch):
    write_catalog(lake.root)
    scanned, real = [], checks.facts

    def counting(rows, *by):
        scanned.append(sorted(str(r.date) for r in rows.select("date").distinct().collect()) if by else None)
        return real(rows, *by)

    monkeypatch.setattr(checks, "facts", counting)

    def same():
        plain = {tuple(r) for r in verify_lake(lake).collect()}
        assert {tuple(r) for r in verify_lake(lake, remember=True).collect()} == plain
        return plain

    first = same()
    odd = [row(VALID + DAY, f"odd{i}:Bay", 1, MORNING, version=i) for i in range(3)] * 2
    write(lake, "part-20250622T000000Z", odd)
    assert same() != first
    same()
    compact(lake, now=LATER, delete_sources=False)
    same()
    compact(lake, now=LATER + DAY)
    same()
    days = [s for s in scanned if s is not None]
    assert days[:2] == [["2025-06-20"], ["2025-06-21"]]  # and nothing the third time
    assert days[2] == ["2025-06-20"]
    storage.delete_below(spark, lake.path("curated", f"product={HILLS}", "date=2025-06-21"), guard=lake.path("curated"))
    spark.catalog.clearCache()
    assert ("series", 1) in {(r[1], r[2]) for r in same()}
