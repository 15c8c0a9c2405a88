import random
from datetime import UTC, datetime, timedelta

import pytest
from helpers import VALID, MORNING, forecast, row
from pyspark.sql import functions as F

from hindcast.operators import reads
from hindcast.operators.asof import asof_join, multi_snapshot
from hindcast.operators.vintages import (
    hour_starting,
    join_zone_series,
    lead_table,
    overlap_join,
    revisions,
    unpivot_leads,
)

HOUR = timedelta(hours=1)


@pytest.fixture(scope="module")
def versions(spark):
    """Random versions of a few keys, with ties and with one key holding half of all rows."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        hot = i % 2
        start = VALID if hot else VALID + HOUR * rng.randrange(4)
        series = "a:X" if hot else rng.choice(["a:X", "b:X", "b:Y"])
        posted = MORNING - timedelta(minutes=15 * rng.randrange(1000))
        source = rng.choice(["live", "previous_runs"])
        late = posted + timedelta(days=rng.randrange(3), seconds=i)
        rows.append(row(start, series, i, posted, ingested=late, source=source))
    return forecast(spark, rows).cache()


def brute_force(versions, decisions):
    """The read rule, decision by decision, in plain Python."""
    known = [r.asDict() for r in versions.collect()]
    out = set()
    for d in decisions:
        candidates = [
            v for v in known
            if v["interval_start"] == d["interval_start"] and v["series"] == d["series"]
            and v["posted_at"] <= d["decision_at"]
        ]
        best = max(candidates, key=lambda v: (v["posted_at"], v["ingested_at"]), default=None)
        out.add((d["id"], best["value"] if best else None, best["posted_at"] if best else None))
    return out


@pytest.mark.parametrize("slice_seconds", [7200, 10**9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_join_equals_the_read_rule(spark, versions, how, slice_seconds):
    rng = random.Random(8)
    instants = [r.posted_at for r in versions.collect()]
    starts = [r.interval_start for r in versions.select("interval_start").distinct().collect()]
    rows = []
    for i in range(300):
        # Half of them exactly on a posting, a few asked twice, some before everything.
        at = rng.choice(instants) if i % 2 else rng.choice(instants) - timedelta(minutes=7)
        series = rng.choice(["a:X", "b:X", "b:Y", "none:Z"])
        rows.append((i, rng.choice(starts), series, at))
    rows += [(1000 + i, *r[1:]) for i, r in enumerate(rows[:40])]
    shape = "id int, interval_start timestamp, series string, decision_at timestamp"
    decisions = spark.createDataFrame(rows, shape)
    found = asof_join(decisions, versions, how=how, slice_seconds=slice_seconds)
    got = [(r.id, r.value, r.posted_at) for r in found.collect()]
    want = brute_force(versions, [r.asDict() for r in decisions.collect()])
    if how == "inner":
        want = {w for w in want if w[1] is not None}
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("moments", ["grid", "grid with gaps", "irregular", "one"])
def test_multi_snapshot_equals_one_snapshot_per_decision(spark, versions, moments):
    back = {
        "grid": [0, 60, 120, 180, 240, 300],
        "grid with gaps": [0, 180, 1500, 1560, 6000],
        "irregular": [0, 7, 1000, 9999],
        "one": [45],
    }[moments]
    taken = [MORNING - timedelta(minutes=m) for m in back]
    rows = [(at, VALID, VALID + 3 * HOUR) for at in taken] + [(taken[-1], VALID + HOUR, VALID + 4 * HOUR)]
    empty = [(taken[0], VALID, VALID)]
    shape = "decision_at timestamp, valid_from timestamp, valid_to timestamp"
    found = multi_snapshot(spark.createDataFrame(rows + empty, shape), versions)
    got = {(r.decision_at, r.interval_start, r.series, r.value) for r in found.collect()}
    want = set()
    for at, start, end in rows:
        for r in reads.snapshot(versions, start, end, as_of=at).collect():
            naive = spark.createDataFrame([(at,)], "t timestamp").first().t
            want.add((naive, r.interval_start, r.series, r.value))
    assert got == want and found.count() == len(got)


def test_no_decisions_give_no_rows(spark, versions):
    shape = "decision_at timestamp, valid_from timestamp, valid_to timestamp"
    assert multi_snapshot(spark.createDataFrame([], shape), versions).count() == 0


def test_asof_plans_form_no_pairs(spark, versions, capsys):
    decisions = versions.select("interval_start", "series", F.col("posted_at").alias("decision_at"))
    asked = decisions.select(
        F.col("decision_at"), F.col("interval_start").alias("valid_from"),
        (F.col("interval_start") + F.expr("INTERVAL 90 MINUTES")).alias("valid_to"),
    )
    for found in (asof_join(decisions, versions), multi_snapshot(asked, versions)):
        found.explain()
        plan = capsys.readouterr().out
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
        assert "posted_at <= " not in plan.replace("#", " ")


def test_no_job_runs_before_the_result_is_used(spark, versions):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans-only", "building a plan")
    decisions = versions.select("interval_start", "series", F.col("posted_at").alias("decision_at"))
    asof_join(decisions, versions)
    multi_snapshot(decisions.withColumnsRenamed({"interval_start": "valid_from"}).withColumn(
        "valid_to", F.col("valid_from") + F.expr("INTERVAL 1 HOUR")), versions)
    assert not tracker.getJobIdsForGroup("plans-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_null_stamps_and_instants_know_nothing(spark):
    rows = spark.createDataFrame(
        [("k", None, "2024-01-01", 9.0), ("k", "2024-01-02", "2024-01-02", 1.0)],
        "series string, p string, i string, value double",
    ).selectExpr(
        "timestamp'2024-01-05' AS interval_start", "series", "to_timestamp(p) AS posted_at",
        "to_timestamp(i) AS ingested_at", "'live' AS source", "value",
    )
    asked = spark.createDataFrame(
        [(1, "k", "2024-01-01"), (2, "k", "2024-01-03"), (3, "k", None), (4, None, "2024-01-03")],
        "id int, series string, d string",
    ).selectExpr("id", "timestamp'2024-01-05' AS interval_start", "series", "to_timestamp(d) AS decision_at")
    left = {r.id: r.value for r in asof_join(asked, rows, how="left").collect()}
    assert left == {1: None, 2: 1.0, 3: None, 4: None}
    assert [r.id for r in asof_join(asked, rows).collect()] == [2]


def test_products_do_not_mix(spark):
    rows = forecast(spark, [row(VALID, "a:X", 1, MORNING), row(VALID, "a:X", 2, MORNING - HOUR)])
    rows = rows.withColumn("product", F.when(F.col("value") == 1, "one").otherwise("two"))
    asked = spark.createDataFrame([(MORNING, VALID, VALID + HOUR)], "decision_at timestamp, valid_from timestamp, valid_to timestamp")
    both = {(r.product, r.value) for r in multi_snapshot(asked, rows).collect()}
    assert both == {("one", 1.0), ("two", 2.0)}
    only = multi_snapshot(asked.withColumn("product", F.lit("two")), rows).collect()
    assert [(r.product, r.value) for r in only] == [("two", 2.0)]
    single = asked.select("decision_at", F.col("valid_from").alias("interval_start"), F.lit("a:X").alias("series"), F.lit("two").alias("product"))
    assert [r.value for r in asof_join(single, rows).collect()] == [2.0]


@pytest.mark.parametrize("minutes", [30, 90, 200])
def test_ranges_off_the_hour(spark, minutes):
    start = VALID + timedelta(minutes=25)
    rows = forecast(spark, [row(start + HOUR * k, "a:X", k, MORNING + timedelta(minutes=25 * k)) for k in range(5)])
    shape = "decision_at timestamp, valid_from timestamp, valid_to timestamp"
    for back in (0, 25, 50):
        at, begin = MORNING + timedelta(minutes=25 + back), VALID + timedelta(minutes=back)
        asked = spark.createDataFrame([(at, begin, begin + timedelta(minutes=minutes))], shape)
        got = {(r.interval_start, r.value) for r in multi_snapshot(asked, rows).collect()}
        want = reads.snapshot(rows, begin, begin + timedelta(minutes=minutes), as_of=at).collect()
        assert got == {(r.interval_start, r.value) for r in want}


def test_revisions_compare_with_the_version_before(spark, versions):
    got = {
        (r.interval_start, r.series, r.posted_at): (r.value, r.previous)
        for r in revisions(versions).collect()
    }
    newest = {}
    for r in versions.collect():
        at = (r.interval_start, r.series, r.posted_at)
        newest[at] = max(newest.get(at, (r.ingested_at, r.value)), (r.ingested_at, r.value))
    want, last = {}, {}
    for at in sorted(newest):
        value = newest[at][1]
        want[at] = (value, last.get(at[:2]))
        last[at[:2]] = value
    assert got == want


def test_lead_table_has_one_column_per_lead(spark):
    back = lambda n: VALID - timedelta(days=n) + HOUR
    rows = [row(VALID, "t:X", 10 * n, back(n)) for n in (1, 2, 3)]
    got = lead_table(forecast(spark, rows), [1, 2, 4]).collect()
    assert [(r.lead_1d, r.lead_2d, r.lead_4d) for r in got] == [(10.0, 20.0, None)]


def test_unpivot_names_lead_and_knowledge_time(spark):
    wide = forecast(spark, [row(VALID, "t:X", 1, MORNING)]).select(
        "interval_start", F.lit(5.0).alias("t_previous_day3"),
        F.lit(float("nan")).alias("t_previous_day1"),
    )
    got = unpivot_leads(wide, ["interval_start"], ["t_previous_day1", "t_previous_day3"])
    got = got.withColumn("back", F.col("interval_start") - F.col("posted_at")).collect()
    assert [(r.variable, r.lead, r.value, r.back) for r in got] == [
        ("t", 3, 5.0, timedelta(days=3) - HOUR)
    ]
    with pytest.raises(ValueError, match="previous_day"):
        unpivot_leads(wide, [], ["interval_start"])


def test_preceding_hour_variables_move_back(spark):
    rows = forecast(spark, [row(VALID, "precipitation:X", 1, MORNING), row(VALID, "temperature_2m:X", 2, MORNING)])
    got = {r.series: r.interval_start for r in hour_starting(rows).collect()}
    assert got["temperature_2m:X"] - got["precipitation:X"] == HOUR
    load = forecast(spark, [row(VALID - HOUR, "load", 7, MORNING)]).select(
        "interval_start", F.lit("X").alias("zone"), F.col("value").alias("load")
    )
    joined = join_zone_series(rows, load).collect()
    assert [(r.series, r.load) for r in joined] == [("precipitation:X", 7.0)]


def test_overlap_join_weighs_by_shared_time(spark):
    def at(hour, minute=0):
        return datetime(2025, 6, 20, hour, minute, tzinfo=UTC)

    shape = "series string, interval_start timestamp, interval_minutes int, value double"
    hours = spark.createDataFrame(
        [("a", at(1), 60, 1.0), ("a", at(1), 60, 1.0), ("a", at(5), 60, 2.0), ("b", at(1), 60, 3.0), (None, at(1), 60, 4.0),
         ("a", None, 60, 5.0), ("long", at(0), 4000, 6.0)], shape,
    )
    parts = spark.createDataFrame(
        [("a", at(0, 50), 15, 10.0), ("a", at(1, 5), 15, 20.0), ("a", at(1, 50), 15, 40.0), ("a", at(1, 20), 15, None),
         ("a", at(1, 35), 15, float("nan")), ("a", at(2), 15, 99.0), (None, at(1), 15, 7.0), ("long", at(0), 3000, 2.0),
         ("long", at(0, 10), 0, 9.0)], shape,
    )
    for bins in (7, 60, 1440):
        found = overlap_join(hours, parts, ["series"], bin_minutes=bins)
        got = {(r.series, r.value): (r.other_value and round(r.other_value, 9), r.shared_minutes) for r in found.collect()}
        assert found.count() == 7 and found.columns == [*hours.columns, "other_value", "shared_minutes"]
        want = (5 * 10 + 15 * 20 + 10 * 40) / 30
        assert got == {
            ("a", 1.0): (round(want, 9), 30.0), ("a", 2.0): (None, 0.0), ("b", 3.0): (None, 0.0), (None, 4.0): (None, 0.0),
            ("a", 5.0): (None, 0.0), ("long", 6.0): (2.0, 3000.0),
        }
    assert overlap_join(hours, parts.limit(0), ["series"]).where("other_value IS NOT NULL").count() == 0
