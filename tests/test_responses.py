import json
import math
from datetime import date, datetime

import pytest
from helpers import MORNING, SMALL, live_response, past_response, responses
from pyspark.sql import functions as F

from hindcast.contract import LIVE, PREVIOUS_RUNS
from hindcast.operators.responses import forecast_rows, trim, zone_values
from hindcast.settings import GFS_SEAMLESS, layouts


def run(spark, *bodies, product=GFS_SEAMLESS, kind=LIVE, **named):
    rows = responses(spark, *bodies, product=product.key, kind=kind, **named)
    return zone_values(rows, layouts(spark, [product], kind), kind)


def one(spark, body, **kwargs):
    return run(spark, body, **kwargs).collect()[0]


def test_a_good_response_becomes_zone_means(spark):
    values = run(spark, live_response())
    got = values.collect()[0]
    assert (got.problem, got.rows, got.dropped) == (None, 432, 0)
    assert got.days == [date(2025, 6, 20)]
    rows = forecast_rows(values, LIVE)
    assert rows.count() == 432
    coast = rows.where("series = 'temperature_2m:Coast'").orderBy("interval_start").collect()
    assert [r.value for r in coast] == [(0 + h / 100 + 1 + h / 100 + 2 + h / 100) / 3 for h in range(6)]
    assert rows.where("posted_at <> ingested_at OR source <> 'live'").count() == 0


def test_a_missing_point_drops_the_zone_hour(spark):
    for gap in ("null", "NaN", "Infinity"):
        body = live_response()
        body[1]["hourly"]["temperature_2m"][2] = "GAP"
        text = json.dumps(body).replace('"GAP"', gap)
        got = one(spark, text)
        assert (got.problem, got.rows, got.dropped) == (None, 431, 1), gap


def _change(entries, what):
    first, second = entries[0], entries[1]
    if what == "an entry removed":
        del entries[3]
    elif what == "location":
        first["latitude"] = 40.0
    elif what == "no location":
        del second["longitude"]
    elif what == "location is text":
        first["latitude"] = "29.76"
    elif what == "variable removed":
        del first["hourly"]["cloud_cover"]
    elif what == "variable added":
        first["hourly"]["snowfall"] = [0.0] * 6
    elif what == "unit":
        second["hourly_units"]["wind_speed_10m"] = "km/h"
    elif what == "time unit":
        first["hourly_units"]["time"] = "iso8601"
    elif what == "other times":
        second["hourly"]["time"] = second["hourly"]["time"][:-1]
    elif what == "short values":
        second["hourly"]["precipitation"] = second["hourly"]["precipitation"][:-1]
    elif what == "long values":
        for entry in entries:
            entry["hourly"]["precipitation"].append(1.0)
    elif what == "text value":
        second["hourly"]["precipitation"][0] = "wet"
    elif what == "null entry":
        entries[4] = None
    elif what == "no time":
        for entry in entries:
            del entry["hourly"]["time"]
    elif what == "null time":
        for entry in entries:
            entry["hourly"]["time"][0] = None
    elif what == "repeated time":
        for entry in entries:
            entry["hourly"]["time"][1] = entry["hourly"]["time"][0]
    return entries


DRIFT = {
    "an entry removed": "21 points in the response, 22 requested",
    "location": "location is not that of Houston",
    "no location": "location is not that of Galveston",
    "location is text": "location is not that of Houston",
    "variable removed": "cloud_cover is missing for Houston",
    "variable added": "undeclared variables in the response: snowfall",
    "unit": "wind_speed_10m is in km/h, declared in m/s for Galveston",
    "time unit": "time is not unixtime for Houston",
    "other times": "different valid times for Galveston",
    "short values": "values and valid times differ in number for Galveston",
    "long values": "values and valid times differ in number for Houston",
    "text value": "hourly values are missing or not numbers for Galveston",
    "null entry": "no readable entry for Longview",
    "no time": "valid times are missing for Houston",
    "null time": "valid times are missing for Houston",
    "repeated time": "a business key repeats within one posting",
}


def test_drift_is_named_and_neighbours_survive(spark):
    bodies = [_change(live_response(), what) for what in DRIFT]
    bodies += [live_response()[0], '"hello"', "{ broken", "[]", live_response()]
    got = [r.problem for r in run(spark, *bodies).orderBy("raw_key").collect()]
    expected = [
        *DRIFT.values(),
        "1 points in the response, 22 requested",
        "response is neither an object nor a list",
        "response is neither an object nor a list",
        "0 points in the response, 22 requested",
        None,
    ]
    by_key = dict(zip(sorted(f"raw/{i}" for i in range(len(bodies))), got, strict=True))
    named = {i: by_key[f"raw/{i}"] for i in range(len(bodies))}
    assert named == dict(enumerate(expected))


def test_an_unconfigured_product_is_a_problem(spark):
    rows = responses(spark, live_response(), product="other")
    got = zone_values(rows, layouts(spark, [GFS_SEAMLESS], LIVE), LIVE).collect()[0]
    assert got.problem == "product declares no such responses"


def test_weights_replay_another_weighting(spark):
    body = live_response(hours=2, product=SMALL)
    rows = forecast_rows(run(spark, body, product=SMALL), LIVE)
    got = {(r.series, r.interval_start.minute, r.value) for r in rows.where("series = 't:A'").collect()}
    assert sorted(v for _, _, v in got) == pytest.approx([0.75, 0.76])


def test_digest_sees_content_only(spark):
    same, moved, flipped = live_response(), live_response(shift=0.5), live_response()
    for entry in flipped:
        for name in entry["hourly"]:
            entry["hourly"][name].reverse()
    got = run(spark, same, same, moved, flipped, live_response(hours=5)).collect()
    digests = {r.raw_key: r.digest for r in got}
    assert digests["raw/0"] == digests["raw/1"] == digests["raw/3"]
    assert len({digests["raw/0"], digests["raw/2"], digests["raw/4"]}) == 3
    zero, minus = live_response(hours=1, product=SMALL), live_response(hours=1, product=SMALL)
    minus[2]["hourly"]["t"][0] = -0.5
    zero[2]["hourly"]["t"][0] = 0.5
    a, b = run(spark, zero, minus, product=SMALL).collect()
    assert a.digest != b.digest


def test_previous_runs_become_vintages(spark):
    values = run(
        spark, past_response(date(2024, 3, 2)), kind=PREVIOUS_RUNS, first=date(2024, 3, 2),
        last=date(2024, 3, 2),
    )
    rows = forecast_rows(values, PREVIOUS_RUNS)
    assert rows.count() == values.collect()[0].rows == 24 * 9 * 8 * 7
    at = rows.where(
        "series = 'temperature_2m:Coast' AND interval_start = timestamp'2024-03-02 12:00:00'"
        " AND posted_at = timestamp'2024-02-28 13:00:00'"
    ).collect()
    assert [r.value for r in at] == [31.0]
    assert rows.select("posting").distinct().collect()[0][0] == "previous-runs"
    holed = one(spark, past_response(date(2024, 3, 2), hole=True), kind=PREVIOUS_RUNS)
    assert (holed.rows, holed.dropped) == (12095, 1)


def test_vintages_from_the_future_are_refused(spark):
    got = one(spark, past_response(date(2025, 6, 28)), kind=PREVIOUS_RUNS, fetched=MORNING)
    assert got.problem == "valid hours would be posted after they were ingested"


def test_trim_shortens_every_series(spark):
    short = trim(responses(spark, live_response(hours=6)), 2).collect()[0].body
    entries = json.loads(short)
    assert len(entries) == 22 and "timezone" not in entries[0]
    assert {len(v) for e in entries for v in e["hourly"].values()} == {2}
    assert one(spark, short).rows == 2 * 72


def test_parsing_is_one_narrow_stage(spark, capsys):
    run(spark, live_response()).explain()
    plan = capsys.readouterr().out
    assert "Exchange hash" not in plan and "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert plan.count("from_json(StructField") <= 2
