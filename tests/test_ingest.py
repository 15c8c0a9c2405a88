import gzip
import json
from datetime import date, datetime, timedelta

import pytest
from helpers import (
    AFTERNOON,
    MORNING,
    SMALL,
    live_response,
    past_response,
    responses,
    utc,
    write_raw,
    write_raw_past,
)
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hindcast.errors import BatchMixUpError, MissingBodyError, QuarantinedError
from hindcast.operators.changes import (
    alarm_hours,
    freshness,
    latest_manifest,
    mark_changes,
    one_per_poll,
)
from hindcast.operators.reads import snapshot
from hindcast.operators.responses import zone_values
from hindcast.plans.curate import curate_live, curate_previous_runs
from hindcast.settings import GFS_SEAMLESS, layouts
from hindcast.sources.lake import Lake
from hindcast.sources.raw import NamedFilesWriter
from hindcast.streaming.freshness import hourly_ages, hourly_alarms
from hindcast.streaming.ingest import ingest, ingest_stream

HOUR = timedelta(hours=1)


def small(shift=0.0, hours=3):
    return live_response(hours=hours, product=SMALL, shift=shift)


def polls_of(lake):
    rows = one_per_poll(lake.polls()).orderBy("fetched_at").collect()
    return [r.new_posting for r in rows]


def stored(lake):
    return {tuple(r) for r in lake.curated().drop("posting").collect()}


def test_only_changed_polls_become_postings(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    polled = responses(spark, small(), small(), small(1), small(), product="small")
    curate_live(lake, [SMALL], polled, "b0")
    assert polls_of(lake) == [True, False, True, True]
    assert lake.curated().select("posted_at").distinct().count() == 3
    assert lake.curated().count() == 3 * 3 * 4
    curate_live(lake, [SMALL], polled, "b0")
    assert lake.curated().count() == 36 and polls_of(lake) == [True, False, True, True]

    later = responses(spark, small(), product="small", fetched=MORNING + 9 * HOUR)
    curate_live(lake, [SMALL], later, "b1")
    assert polls_of(lake) == [True, False, True, True, False]
    manifest = latest_manifest(one_per_poll(lake.polls())).collect()[0]
    assert manifest.last_checked_at - manifest.last_posted_at == 6 * HOUR
    assert (manifest.rows, manifest.dropped, manifest.raw_key) == (12, 0, "raw/3")
    assert manifest.partitions == [date(2025, 6, 20)]


def test_a_failing_response_does_not_stop_the_others(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    polled = responses(spark, "{", small(), product="small")
    curate_live(lake, [SMALL], polled, "b0")
    assert [r.raw_key for r in lake.quarantine().collect()] == ["raw/0"]
    assert polls_of(lake) == [True] and lake.curated().count() == 12
    bad = responses(spark, small(), product="../evil")
    curate_live(lake, [SMALL], bad, "b1")
    assert lake.curated_products() == ["small"]
    assert "../evil" in [r.product for r in lake.quarantine().collect()]


def test_a_late_poll_is_fitted_in_by_time(spark, tmp_path):
    """A, (B late), A: without B the second A brings nothing new; with it, it does."""
    lake = Lake(spark, tmp_path)
    all_polls = responses(spark, small(), small(5), small(), product="small").withColumn(
        "date", F.to_date("fetched_at")
    )
    on_time, late = all_polls.where("raw_key <> 'raw/1'"), all_polls.where("raw_key = 'raw/1'")
    curate_live(lake, [SMALL], on_time, "b0")
    assert polls_of(lake) == [True, False]
    before = stored(lake)
    with pytest.raises(MissingBodyError, match="small"):
        curate_live(lake, [SMALL], late, "b1")
    assert polls_of(lake) == [True, False]
    lake.land_responses(on_time, "landed")
    done = {r.product: r for r in curate_live(lake, [SMALL], late, "b1").collect()}["small"]
    assert (done.responses, done.postings, done.rows) == (1, 2, 24) and stored(lake) > before
    assert polls_of(lake) == [True, True, True]
    curate_live(lake, [SMALL], late, "b1")
    assert polls_of(lake) == [True, True, True] and lake.curated().count() == 36

    straight = Lake(spark, tmp_path / "straight")
    curate_live(straight, [SMALL], all_polls, "b0")
    assert stored(lake) == stored(straight)


def test_a_batch_name_is_not_used_for_other_responses(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    polled = responses(spark, small(), small(1), product="small")
    curate_live(lake, [SMALL], polled.where("raw_key = 'raw/0'"), "b0")
    with pytest.raises(BatchMixUpError):
        curate_live(lake, [SMALL], polled.where("raw_key = 'raw/1'"), "b0")
    assert polls_of(lake) == [True] and lake.curated().count() == 12


def test_two_streams_keep_out_of_each_others_way(spark, tmp_path):
    lake = Lake(spark, tmp_path / "lake")
    write_raw(tmp_path / "lake", "small", MORNING, small())
    for where in ("one", "two"):
        ingest(lake, [SMALL], str(tmp_path / where), unit="batch")
    assert lake.curated().count() == 24 and len(stored(lake)) == 12
    lake.land_responses(responses(spark, small(3), product="small", fetched=MORNING + HOUR), "l")
    did = ingest(lake, [SMALL], str(tmp_path / "three"), unit="batch", landed=True)
    assert [(r.polls, r.postings, r.rows) for r in did.collect()] == [(1, 1, 12)]
    assert polls_of(lake) == [True, True] and len(stored(lake)) == 24


def test_a_run_with_refused_responses_fails_in_the_end(spark, tmp_path):
    lake = Lake(spark, tmp_path / "lake")
    write_raw(tmp_path / "lake", "small", MORNING, "not json")
    write_raw(tmp_path / "lake", "small", MORNING + HOUR, small())
    with pytest.raises(QuarantinedError, match="small .*fetched="):
        ingest(lake, [SMALL], str(tmp_path / "progress"))
    assert polls_of(lake) == [True] and lake.curated().count() == 12
    ingest(lake, [SMALL], str(tmp_path / "progress"))


def test_landed_bodies_are_never_replaced(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    first = responses(spark, small(), small(1), product="small")
    lake.land_responses(first, "l0")
    lake.land_responses(first, "l0")
    assert lake.responses().count() == 2
    lake.land_responses(responses(spark, small(2), product="small"), "l0")
    assert lake.responses().count() == 3


def test_an_older_fetch_does_not_replace_a_newer_one(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    day = date(2024, 3, 2)

    def past(at, hole):
        body = past_response(day, product=SMALL)
        if hole:
            body[2]["hourly"]["t_previous_day2"][5] = None
        return responses(
            spark, body, product="small", kind="previous_runs", fetched=at, first=day, last=day
        )

    curate_previous_runs(lake, [SMALL], past(MORNING + HOUR, False), "b0")
    whole = stored(lake)
    done = curate_previous_runs(lake, [SMALL], past(MORNING, True), "b1").collect()[0]
    assert stored(lake) == whole and (done.responses, done.days) == (1, 1)
    assert lake.windows().count() == 2
    curate_previous_runs(lake, [SMALL], past(MORNING + 2 * HOUR, True), "b2")
    assert lake.curated().count() == len(whole) - 1


def test_the_log_is_read_from_the_batch_on(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for k in range(3):
        polled = responses(spark, small(k), product="small", fetched=MORNING + 30 * k * 24 * HOUR)
        curate_live(lake, [SMALL], polled, f"b{k}")
    assert polls_of(lake) == [True, True, True]
    plan = lake.polls(date(2025, 7, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_response_landed_twice_is_published_once(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    polled = responses(spark, small(), small(1), product="small")
    curate_live(lake, [SMALL], polled.unionAll(polled), "b0")
    assert lake.curated().count() == 24 and polls_of(lake) == [True, True]
    curate_live(lake, [SMALL], polled, "b1")
    assert lake.curated().count() == 24
    day = date(2024, 3, 2)
    past = responses(
        spark, past_response(day, product=SMALL), product="small", kind="previous_runs",
        first=day, last=day,
    )
    curate_previous_runs(lake, [SMALL], past.unionAll(past), "b2")
    assert lake.curated().count() == 24 + 192


def test_batch_units_hold_the_same_rows(spark, tmp_path):
    lake, other = Lake(spark, tmp_path / "a"), Lake(spark, tmp_path / "b")
    polled = responses(spark, small(), small(1), product="small")
    curate_live(lake, [SMALL], polled, "b0")
    curate_live(other, [SMALL], polled, "b0", unit="batch")
    assert stored(lake) == stored(other)
    assert [r.posting for r in other.curated().select("posting").distinct().collect()] == ["batch-b0"]


def test_refetched_days_replace_what_was_there(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    day = date(2024, 3, 2)
    past = lambda body, at: responses(
        spark, body, product="small", kind="previous_runs", fetched=at, first=day, last=day
    )
    body = past_response(day, product=SMALL)
    curate_previous_runs(lake, [SMALL], past(body, MORNING), "b0")
    first = lake.curated().count()
    assert first == 24 * 4 * 2
    both = past(body, MORNING + HOUR).unionByName(
        past(past_response(day, product=SMALL, hole=False), MORNING + 2 * HOUR)
    )
    curate_previous_runs(lake, [SMALL], both, "b1")
    assert lake.curated().count() == first
    ages = lake.curated().agg(F.min("ingested_at") == F.max("ingested_at")).first()
    assert ages[0]
    assert lake.windows().count() == 3


@pytest.mark.parametrize("unit", ["posting", "batch"])
def test_streams_pick_up_new_files_once(spark, tmp_path, unit):
    root, lake = tmp_path / "lake", Lake(spark, tmp_path / "lake")

    def ingest(kind="live"):
        where = str(tmp_path / f"progress-{kind}")
        ingest_stream(lake, [SMALL], where, kind=kind, unit=unit).awaitTermination()

    write_raw(root, "small", MORNING, small())
    write_raw(root, "small", MORNING + HOUR, small())
    write_raw(root, "small", MORNING + 2 * HOUR, "not json")
    day = date(2024, 3, 2)
    write_raw_past(root, "small", MORNING, day, day, past_response(day, product=SMALL))
    ingest()
    assert polls_of(lake) == [True, False] and lake.quarantine().count() == 1
    ingest("previous_runs")
    assert lake.curated().groupBy("source").count().orderBy("source").collect()[1]["count"] == 192
    window = lake.windows().collect()[0]
    assert (window.first, window.last, window.rows) == (day, day, 192)
    ingest()
    assert lake.polls().count() == 2
    write_raw(root, "small", MORNING + 3 * HOUR, small(2))
    ingest()
    assert polls_of(lake) == [True, False, True]
    write_raw(root, "small", MORNING + HOUR / 2, small(7))
    ingest()
    assert polls_of(lake) == [True, True, True, True]
    known = snapshot(
        lake.curated().drop("product", "posting"), utc(datetime(2025, 6, 20)),
        utc(datetime(2025, 6, 21)), as_of=MORNING + 2 * HOUR,
    )
    assert sorted(r.value for r in known.where("series = 't:B'").collect()) == [2.0, 2.01, 2.02]
    assert lake.raw_files().count() == 6
    assert lake.raw_files([date(2025, 6, 20)]).where("kind = 'live'").count() == 5
    assert lake.raw_files([date(2025, 6, 21)]).count() == 0


def test_the_default_product_end_to_end(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    write_raw(tmp_path, GFS_SEAMLESS.key, MORNING, live_response())
    curate_live(lake, [GFS_SEAMLESS], lake.raw_files().where("kind = 'live'"), "b0")
    assert lake.curated([GFS_SEAMLESS.key]).count() == 432
    poll = lake.polls().collect()[0]
    assert poll.raw_key.endswith(f"raw/{GFS_SEAMLESS.key}/date=2025-06-20/fetched=20250620T021000Z.json.gz")


def test_landing_a_batch_twice_keeps_it_once(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    polled = responses(spark, small(), small(1), product="small")
    lake.land_responses(polled, "l0")
    lake.land_responses(polled, "l0")
    lake.land_responses(responses(spark, small(2), product="small", fetched=MORNING + 5 * HOUR), "l1")
    assert lake.responses().count() == 3
    curate_live(lake, [SMALL], lake.responses(), "b0")
    assert polls_of(lake) == [True, True, True]


def test_manifests_kept_as_files_can_be_read(spark, tmp_path):
    path = tmp_path / "manifests" / GFS_SEAMLESS.key
    path.mkdir(parents=True)
    doc = {"product": GFS_SEAMLESS.key, "rows": 3, "last_posted_at": "2025-06-20T02:10:00Z", "new_field": 1}
    (path / "latest.json").write_text(json.dumps(doc, indent=1))
    got = Lake(spark, tmp_path).manifests().collect()
    assert [(r.product, r.rows) for r in got] == [(GFS_SEAMLESS.key, 3)]


def test_changes_across_slices(spark):
    digests = "AABBBABBCA"
    rows = [("p", MORNING + i * HOUR, d) for i, d in enumerate(digests)]
    polls = spark.createDataFrame(rows, "product string, fetched_at timestamp, digest string")
    want = [i == 0 or digests[i] != digests[i - 1] for i in range(len(digests))]
    for seconds in (3600, 7200, 10**9):
        marked = mark_changes(polls, slice_seconds=seconds).orderBy("fetched_at")
        assert [r.changed for r in marked.collect()] == want


def test_hourly_ages_as_a_stream(spark, tmp_path):
    rows = [(MORNING + timedelta(minutes=m), float(m)) for m in (1, 30, 61, 62, 300)]
    made = spark.createDataFrame(rows, "checked_at timestamp, age_minutes double")
    made.write.parquet(str(tmp_path / "checks"))
    stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / "checks"))
    query = (
        hourly_ages(stream).writeStream.format("memory").queryName("ages").outputMode("update")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = [r.max_age_minutes for r in spark.table("ages").orderBy("hour").collect()]
    assert got == [30.0, 62.0, 300.0]


CHECKS = "product string, checked_at timestamp, age_minutes double"


def closed_hours(spark, folder, batches, *, clock=None, **how):
    """Hours given after each batch of checks (one file each), by one stream that is run again."""
    found = []
    for i, rows in enumerate([[], *batches]):
        spark.createDataFrame(rows, CHECKS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if not i:  # the folder must exist
            continue
        stream = spark.readStream.schema(CHECKS).parquet(f"{folder}/in")
        ticks = clock and spark.readStream.schema("timestamp timestamp").parquet(clock)
        hourly_alarms(stream, MORNING.replace(minute=0), threshold_min=240, clock=ticks, **how).writeStream.option(
            "checkpointLocation", f"{folder}/state"
        ).option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
        kinds = "product string, hour timestamp, max_age_minutes double, breach boolean, alarm boolean"
        out = spark.read.schema(kinds).parquet(f"{folder}/out").orderBy("product", "hour").collect()
        since = [round((r.hour.timestamp() - MORNING.replace(minute=0).timestamp()) / 3600) for r in out]
        found.append([(r.product, h, *r[2:]) for r, h in zip(out, since, strict=True)])
    return found


def test_alarms_as_hours_end(spark, tmp_path):
    at = lambda p, h, age: (p, MORNING.replace(minute=9) + timedelta(hours=h), age)
    nan = float("nan")
    first = [at("a", 0, 10.0), at("a", 0, 5.0), at("b", 0, 241.0), at("b", 1, None), (None, MORNING, 1.0), ("a", None, 1.0)]
    second = [at("a", 3, 240.0), at("a", 1, 300.0), at("a", -5, 1.0)]
    third = [at("a", 0, 999.0), at("b", 4, nan), at("b", 4, 7.0), at("c", 6, 1.0)]
    got = closed_hours(spark, tmp_path / "a", [first, second, third])
    # the greatest hour less an hour's grace
    assert got[0] == []
    assert got[1] == [
        ("a", 0, 10.0, False, False), ("a", 1, 300.0, True, False),
        ("b", 0, 241.0, True, True), ("b", 1, None, True, True),
    ]
    added = [
        ("a", 2, None, True, True), ("a", 3, 240.0, False, False), ("a", 4, None, True, False),
        ("b", 2, None, True, True), ("b", 3, None, True, True), ("b", 4, 7.0, False, False),
    ]
    never = [("c", h, None, True, True) for h in range(5)]
    assert got[2] == sorted(got[1] + added + never, key=lambda r: r[:2])


def test_alarms_while_nobody_checks(spark, tmp_path):
    ticks = [(MORNING.replace(minute=0) + timedelta(hours=h),) for h in range(4)]
    spark.createDataFrame(ticks, "timestamp timestamp").write.parquet(str(tmp_path / "clock"))
    one = [("a", MORNING, 10.0)]
    (got,) = closed_hours(spark, tmp_path / "a", [one], clock=str(tmp_path / "clock"))
    assert got == [("a", 0, 10.0, False, False), ("a", 1, None, True, False)]
    assert closed_hours(spark, tmp_path / "b", [one]) == [[]]


def test_freshness_and_alarm(spark):
    posted = spark.createDataFrame(
        [("a", MORNING), ("a", MORNING - HOUR), ("b", MORNING - 5 * HOUR)], "product string, posted_at timestamp"
    )
    got = freshness(posted, MORNING + HOUR, stale_after_min=240).orderBy("product").collect()
    assert [(r.age_minutes, r.stale) for r in got] == [(60.0, False), (360.0, True)]

    made = [(0, 10.0), (1, 300.0), (1, 20.0), (2, 250.0), (3, 240.0), (6, 5.0)]
    start = MORNING.replace(minute=0)
    checks = spark.createDataFrame(
        [(start + h * HOUR + timedelta(minutes=9), age) for h, age in made],
        "checked_at timestamp, age_minutes double",
    )
    hours = alarm_hours(checks, start, start + 7 * HOUR, threshold_min=240).orderBy("hour")
    got = [(r.breach, r.alarm) for r in hours.collect()]
    breach = [False, True, True, False, True, True, False]
    alarm = [False, False, True, False, False, True, False]
    assert got == list(zip(breach, alarm, strict=True))


# -- bodies kept as files, and runs that know their own failures -------------------------------


def test_bodies_are_kept_as_they_came(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    body = '[{"é": 1}]\n\n'
    rows = responses(spark, body, "[]", product="small")
    past = responses(spark, "{}", product="small", kind="previous_runs", first=date(2025, 6, 1), last=date(2025, 6, 3))
    lake.keep_raw(rows.unionByName(past))
    names = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.gz"))
    day = "raw/small/date=2025-06-20"
    assert names == [
        f"{day}/fetched=20250620T021000Z.json.gz",
        f"{day}/fetched=20250620T031000Z.json.gz",
        f"{day}/previous-runs-2025-06-01_2025-06-03-20250620T021000Z.json.gz",
    ]
    assert gzip.decompress((tmp_path / names[0]).read_bytes()).decode() == body
    assert [p.name for p in tmp_path.rglob("_*") if p.is_file()] == []
    found = {(r.kind, r.first, r.body) for r in lake.raw_files().collect()}
    assert found == {("live", None, body), ("live", None, "[]"), ("previous_runs", date(2025, 6, 1), "{}")}
    lake.keep_raw(responses(spark, "other", product="small"))
    assert gzip.decompress((tmp_path / names[0]).read_bytes()).decode() == body


def test_a_failed_write_of_bodies_leaves_none(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    bad = responses(spark, "[]", product="../evil").unionByName(responses(spark, "[]", product="small"))
    with pytest.raises(Exception, match="not a product key"):
        lake.keep_raw(bad.coalesce(1))
    assert [p for p in tmp_path.rglob("*.gz") if not p.name.startswith("_")] == []


def test_the_writer_commits_once_and_aborts(tmp_path):
    writer = NamedFilesWriter(f"file:{tmp_path}")
    rows = [{"name": "raw/a/x.json", "body": "1"}, {"name": "raw/a/y.json.gz", "body": "2"}]
    first, second = writer.write(iter(rows)), writer.write(iter(rows))
    writer.abort([second, None])
    writer.commit([first, None])
    assert sorted(p.name for p in (tmp_path / "raw/a").iterdir()) == ["x.json", "y.json.gz"]
    writer.commit([writer.write(iter([{"name": "raw/a/x.json", "body": "3"}]))])
    assert (tmp_path / "raw/a/x.json").read_text() == "1"
    with pytest.raises(ValueError, match="not a name"):
        writer.write(iter([{"name": "raw/../x", "body": ""}]))


def test_a_replayed_batch_fails_for_what_it_refused(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path / "lake")
    lake.keep_raw(responses(spark, "junk", product="small"))
    real = Lake.write_postings

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(Lake, "write_postings", dies)
    with pytest.raises(StreamingQueryException):
        ingest(lake, [SMALL], str(tmp_path / "progress"))
    assert lake.quarantine().count() == 1
    monkeypatch.setattr(Lake, "write_postings", real)
    with pytest.raises(QuarantinedError, match="small"):
        ingest(lake, [SMALL], str(tmp_path / "progress"))
    ingest(lake, [SMALL], str(tmp_path / "progress"))


def test_what_another_stream_refuses_is_not_this_runs_failure(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path / "lake")
    lake.keep_raw(responses(spark, json.dumps(live_response(product=SMALL)), product="small"))
    real = Lake.write_postings

    def meanwhile(self, rows):
        bad = responses(spark, "junk", product="small", fetched=AFTERNOON)
        shape = zone_values(bad, layouts(spark, [SMALL], "live"), "live").where("problem IS NOT NULL")
        columns = ("product", F.lit("live").alias("kind"), "fetched_at", "raw_key", "problem")
        self.log_quarantine(shape.select(*columns), "other-stream-0-live")
        real(self, rows)

    monkeypatch.setattr(Lake, "write_postings", meanwhile)
    ingest(lake, [SMALL], str(tmp_path / "progress"))
    assert lake.quarantine().count() == 1
