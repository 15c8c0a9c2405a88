"""From responses to curated rows, and from polls to postings."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from acceptance.inputs import (
    AS_OF,
    BASE,
    BEYOND,
    DAILY_SQL,
    NOW,
    POLLED_SQL,
    UNITS,
    daily_responses,
    events,
    plain,
    polled_responses,
    products,
    table,
)
from hindcast.contract import LIVE, PREVIOUS_RUNS
from hindcast.errors import QuarantinedError
from hindcast.operators.changes import freshness as freshness_of
from hindcast.operators.changes import latest_manifest as manifest_of
from hindcast.operators.changes import mark_changes
from hindcast.operators.reads import snapshot
from hindcast.operators.responses import forecast_rows, trim, zone_values
from hindcast.plans import report
from hindcast.plans.curate import curate_live, curate_previous_runs
from hindcast.plans.report import quarantined
from hindcast.session import shared_folder
from hindcast.settings import Backfill, layouts
from hindcast.sources.lake import Lake
from hindcast.streaming.ingest import ingest, ingest_stream


STALE_AFTER = products()[0].stale_after_min


def _values(spark, responses, specs=None):
    return zone_values(responses, layouts(spark, specs or products(), LIVE), LIVE)


def curated_rows(spark, sf):
    """All-or-nothing zone means of every response."""
    rows = forecast_rows(_values(spark, daily_responses(spark, sf)), LIVE)
    return plain(
        rows.select(
            "product", "interval_start", "posted_at", "series", F.round("value", 6).alias("value")
        )
    )


CURATED_SQL = f"""WITH {DAILY_SQL}
SELECT product, interval_start, fetched_at AS posted_at, concat(variable, ':', zone) AS series,
  round(avg(value), 6) AS value
FROM zoned GROUP BY product, interval_start, fetched_at, variable, zone HAVING count(*) = 2"""


def reweighted_rows(spark, sf):
    """The same responses replayed with the second point of each zone counting three times."""
    specs = products(weighted=True)
    rows = forecast_rows(_values(spark, daily_responses(spark, sf), specs), LIVE)
    return plain(
        rows.select("product", "interval_start", "series", F.round("value", 6).alias("value"))
    )


REWEIGHTED_SQL = f"""WITH {DAILY_SQL}
SELECT product, interval_start, concat(variable, ':', zone) AS series,
  round(sum(value * weight) / 4, 6) AS value
FROM zoned GROUP BY product, interval_start, variable, zone HAVING count(*) = 2"""


def response_summary(spark, sf):
    """Rows kept and zone-hours dropped per response, with the hours they cover."""
    found = _values(spark, daily_responses(spark, sf))
    return plain(
        found.select("product", "fetched_at", "rows", "dropped", "valid_from", "valid_to", "problem")
    )


SUMMARY_PARTS = f"""{DAILY_SQL},
kept AS (SELECT product, fetched_at, interval_start, variable, zone, avg(value) AS value FROM zoned
         GROUP BY product, fetched_at, interval_start, variable, zone HAVING count(*) = 2),
summed AS (SELECT r.product, r.fetched_at, count(interval_start) AS rows,
    string_agg(concat(interval_start, variable, zone, value), ',' ORDER BY interval_start, variable, zone) AS hash_of
  FROM (SELECT DISTINCT product, fetched_at FROM zoned) r LEFT JOIN kept USING (product, fetched_at)
  GROUP BY r.product, r.fetched_at)"""

SUMMARY_SQL = f"""WITH {DAILY_SQL},
kept AS (SELECT product, fetched_at, interval_start FROM zoned
         GROUP BY product, fetched_at, interval_start, variable, zone HAVING count(*) = 2)
SELECT product, fetched_at, CAST(count(interval_start) AS INTEGER) AS rows,
  CAST(144 - count(interval_start) AS INTEGER) AS dropped, min(interval_start) AS valid_from,
  max(interval_start) AS valid_to, CAST(NULL AS VARCHAR) AS problem
FROM (SELECT DISTINCT product, fetched_at FROM zoned) r LEFT JOIN kept USING (product, fetched_at)
GROUP BY ALL"""


def response_drift(spark, sf):
    """Responses spoiled by day of month, and the problem each is refused for."""
    day, body = F.dayofmonth("fetched_at"), F.col("body")
    spoiled = (
        F.when(day % 8 == 1, F.replace(body, F.lit('"unixtime"'), F.lit('"iso8601"')))
        .when(day % 8 == 2, F.replace(body, F.lit('"EUR"'), F.lit('"USD"')))
        .when(day % 8 == 3, F.replace(body, F.lit('"latitude":11.0'), F.lit('"latitude":40.0')))
        .when(day % 8 == 4, F.replace(body, F.lit('"amount":['), F.lit('"total":[')))
        .when(day % 8 == 5, F.concat(F.lit('"'), F.lit("text"), F.lit('"')))
        .when(day % 8 == 6, F.replace(body, F.lit('"amount":['), F.lit('"amount":["x",')))
        .when(day % 8 == 7, F.to_json(F.from_json(body, "array<map<string,string>>")[0]))
        .otherwise(body)
    )
    found = _values(spark, daily_responses(spark, sf).withColumn("body", spoiled))
    return found.groupBy("problem").agg(
        F.count("*").alias("responses"), F.sum("rows").alias("rows")
    )


DRIFT_SQL = f"""WITH {DAILY_SQL},
kept AS (SELECT product, fetched_at, variable FROM zoned
         GROUP BY product, fetched_at, interval_start, variable, zone HAVING count(*) = 2),
counted AS (
  SELECT r.product, r.fetched_at, count(variable) AS rows
  FROM (SELECT DISTINCT product, fetched_at FROM zoned) r
  LEFT JOIN kept USING (product, fetched_at) GROUP BY r.product, r.fetched_at),
named AS (
  SELECT CASE day(fetched_at) % 8
    WHEN 1 THEN 'time is not unixtime for n1'
    WHEN 2 THEN 'amount is in USD, declared in EUR for n1'
    WHEN 3 THEN 'location is not that of n2'
    WHEN 4 THEN 'undeclared variables in the response: total'
    WHEN 5 THEN 'response is neither an object nor a list'
    WHEN 6 THEN 'hourly values are missing or not numbers for n1'
    WHEN 7 THEN '1 points in the response, 6 requested' END AS problem,
    CASE WHEN day(fetched_at) % 8 = 0 THEN rows END AS rows FROM counted)
SELECT problem, count(*) AS responses, CAST(sum(rows) AS BIGINT) AS rows FROM named GROUP BY ALL"""


def response_times(spark, sf):
    """Responses whose valid times are spoiled by day of month: one point's differ, are more than its
    values, are null, or an hour stands twice."""
    day, body = F.dayofmonth("fetched_at"), F.col("body")
    times = r'"time":\['
    spoiled = (
        F.when(day % 5 == 1, F.regexp_replace(body, f"^(.*{times})[^,]+", "$1-7.0"))  # the last point's
        .when(day % 5 == 2, F.regexp_replace(body, f"^(.*?{times})", "$1-7.0,"))  # the first point's
        .when(day % 5 == 3, F.regexp_replace(body, f"^(.*?{times})[^,]+", "$1null"))
        .when(day % 5 == 4, F.regexp_replace(body, f"({times})([^,]+),[^,]+", "$1$2,$2"))
        .otherwise(body)
    )
    found = _values(spark, daily_responses(spark, sf).withColumn("body", spoiled))
    return found.groupBy("product", "problem").agg(
        F.count("*").alias("responses"), F.sum("rows").alias("rows")
    )


TIMES_SQL = f"""WITH {DAILY_SQL},
kept AS (SELECT product, fetched_at, variable, zone, hour(interval_start) AS hour FROM zoned
         GROUP BY product, fetched_at, interval_start, variable, zone HAVING count(*) = 2),
twice AS (SELECT DISTINCT product, fetched_at FROM kept WHERE hour IN (0, 1)
          GROUP BY product, fetched_at, variable, zone HAVING count(*) = 2),
counted AS (
  SELECT r.product, r.fetched_at, count(variable) AS rows
  FROM (SELECT DISTINCT product, fetched_at FROM zoned) r
  LEFT JOIN kept USING (product, fetched_at) GROUP BY r.product, r.fetched_at),
named AS (
  SELECT product, CASE WHEN day(fetched_at) % 5 IN (0, 4) THEN rows END AS rows, CASE day(fetched_at) % 5
    WHEN 1 THEN 'different valid times for w2'
    WHEN 2 THEN 'values and valid times differ in number for n1'
    WHEN 3 THEN 'valid times are missing for n1'
    WHEN 4 THEN CASE WHEN (product, fetched_at) IN (SELECT (product, fetched_at) FROM twice)
                THEN 'a business key repeats within one posting' END END AS problem FROM counted)
SELECT product, problem, count(*) AS responses,
  CAST(sum(rows) AS BIGINT) AS rows FROM named GROUP BY ALL"""


def response_trim(spark, sf):
    """Responses cut to their first eight hours, then curated as usual."""
    rows = forecast_rows(_values(spark, trim(daily_responses(spark, sf), 8)), LIVE)
    return rows.groupBy("product", "series").agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total")
    )


TRIM_SQL = f"""WITH {DAILY_SQL}, kept AS (
  SELECT product, concat(variable, ':', zone) AS series, avg(value) AS value FROM zoned
  WHERE hour(interval_start) < 8
  GROUP BY product, interval_start, variable, zone HAVING count(*) = 2)
SELECT product, series, count(*) AS rows, round(sum(value), 4) AS total FROM kept GROUP BY ALL"""


def response_roundtrip(spark, sf):
    """Small JSON objects parsed into maps and taken apart again."""
    pairs = events(spark, sf).select(
        "event_type", F.explode(F.from_json("props", "map<string, double>")).alias("key", "value")
    )
    return pairs.groupBy("event_type", "key").agg(
        F.count("*").alias("rows"), F.sum("value").cast("long").alias("total")
    )


ROUNDTRIP_SQL = """SELECT event_type, 'k' AS key, count(*) AS rows,
  CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total
FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY ALL"""


def zone_mean(spark, sf):
    """Weekly order value per nation as points, regions as zones: a region's week counts only
    if all its nations have one. Points are added in order, so the mean is the same to the bit."""
    nations = table(spark, sf, "nation")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    point = (
        table(spark, sf, "orders")
        .select("o_custkey", cents.alias("cents"), F.date_trunc("week", "o_orderdate").alias("week"))
        .join(
            table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .groupBy("c_nationkey", "week")
        .agg((F.sum("cents").cast("double") / F.count("*")).alias("value"))
    )
    size = nations.groupBy("n_regionkey").agg(F.count("*").alias("points"))
    zones = nations.join(size, "n_regionkey").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    members = F.array_sort(F.collect_list(F.struct("n_nationkey", "value")))["value"]
    grouped = (
        point.join(zones, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "week", "points")
        .agg(members.alias("members"))
    )
    kept = F.size("members") == F.col("points")
    total = F.aggregate("members", F.lit(0.0), lambda acc, v: acc + v)
    return plain(
        grouped.select(
            F.col("r_name").alias("zone"), "week", kept.alias("kept"),
            F.when(kept, total / F.col("points")).alias("cents"),
        )
    )


ZONE_MEAN_SQL = """WITH p AS (
  SELECT c_nationkey, CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS week,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
n AS (SELECT *, count(*) OVER (PARTITION BY n_regionkey) AS points FROM nation),
g AS (SELECT r_name AS zone, week, points, list(value ORDER BY n_nationkey) AS members
      FROM p JOIN n ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY r_name, week, points)
SELECT zone, week, len(members) = points AS kept,
  CASE WHEN len(members) = points
       THEN list_reduce(list_prepend(0.0::DOUBLE, members), lambda a, v: a + v) / points END AS cents
FROM g"""


def _flag_polls(spark, sf):
    """Daily polls per user group: which event types came at least four times that day."""
    flags = (
        events(spark, sf)
        .groupBy(
            (F.col("user_id") % 8).cast("string").alias("product"),
            F.date_trunc("day", "ts").alias("fetched_at"),
            "event_type",
        )
        .agg(F.when(F.count("*") >= 4, 1).otherwise(0).alias("flag"))
    )
    lines = F.array_sort(F.collect_list(F.concat_ws("=", "event_type", "flag")))
    return flags.groupBy("product", "fetched_at").agg(
        F.sha2(F.array_join(lines, ","), 256).alias("digest"),
        F.count("*").alias("rows"),
        F.count_if(F.col("flag") == 0).alias("dropped"),
    )


FLAG_SQL = """flags AS (
  SELECT CAST(user_id % 8 AS VARCHAR) AS product, date_trunc('day', ts) AS fetched_at, event_type,
         CASE WHEN count(*) >= 4 THEN 1 ELSE 0 END AS flag FROM events GROUP BY ALL),
polls AS (
  SELECT product, CAST(fetched_at AS TIMESTAMP) AS fetched_at, count(*) AS rows,
         count(*) FILTER (flag = 0) AS dropped,
         sha256(string_agg(concat(event_type, '=', flag), ',' ORDER BY event_type)) AS digest
  FROM flags GROUP BY product, fetched_at),
marked AS (
  SELECT *, digest IS DISTINCT FROM lag(digest) OVER (PARTITION BY product ORDER BY fetched_at)
    AS new_posting FROM polls)"""


def poll_changes(spark, sf):
    marked = mark_changes(_flag_polls(spark, sf), slice_seconds=5 * 86400)
    return plain(
        marked.select("product", "fetched_at", "digest", F.col("changed").alias("new_posting"))
    )


def latest_manifest(spark, sf):
    """The newest posting per product, and the last time it was checked."""
    none = F.lit(None)
    polls = mark_changes(_flag_polls(spark, sf)).withColumnRenamed("changed", "new_posting")
    polls = polls.withColumns(
        {
            "valid_from": none.cast("timestamp"), "valid_to": none.cast("timestamp"),
            "partitions": none.cast("array<date>"), "raw_key": none.cast("string"),
        }
    )
    return plain(
        manifest_of(polls).select(
            "product", "last_posted_at", "last_checked_at", "content_hash", "rows", "dropped"
        )
    )


MANIFEST_SQL = f"""WITH {FLAG_SQL},
c AS (SELECT product, max(fetched_at) AS last_checked_at FROM marked GROUP BY product),
n AS (SELECT * FROM marked WHERE new_posting
      QUALIFY row_number() OVER (PARTITION BY product ORDER BY fetched_at DESC) = 1)
SELECT product, fetched_at AS last_posted_at, last_checked_at, digest AS content_hash, rows, dropped
FROM n JOIN c USING (product)"""


def freshness(spark, sf):
    posted = events(spark, sf).select(F.col("event_type").alias("product"), "ts")
    found = freshness_of(posted, NOW, stale_after_min=30, posted_at="ts")
    return plain(found.withColumn("age_minutes", F.round("age_minutes", 4)))


FRESHNESS_SQL = """SELECT event_type AS product, max(ts) AS last_posted_at,
  round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 6e7, 4) AS age_minutes,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 6e7 > 30 AS stale
FROM events GROUP BY event_type"""


def _ingested(spark, sf, batches):
    """A lake fed from landed responses, batch by batch."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    responses = polled_responses(spark, sf)
    checkpoint = shared_folder(spark, "progress")
    for number, wanted in enumerate(batches):
        lake.land_responses(responses.where(wanted), f"landing-{number}")
        query = ingest_stream(lake, products(), checkpoint, unit="batch", landed=True)
        query.awaitTermination()
    return lake


def streaming_ingest(spark, sf):
    """Responses landed in two halves and ingested as streams: only changes become postings."""
    lake = _ingested(spark, sf, [F.col("fetched_at") < AS_OF, F.col("fetched_at") >= AS_OF])
    rows = lake.curated()
    return plain(rows.select("product", "interval_start", "posted_at", "series", "value", "source"))


STREAM_SQL = f"""WITH {POLLED_SQL}
SELECT m.product, interval_start, m.fetched_at AS posted_at, series, value, 'live' AS source
FROM means m JOIN polls p ON m.product = p.product AND m.fetched_at = p.fetched_at
WHERE new_posting"""


def late_ingest(spark, sf):
    """The later half arrives first. What was known at any time is answered all the same."""
    lake = _ingested(spark, sf, [F.col("fetched_at") >= AS_OF, F.col("fetched_at") < AS_OF])
    return _answers(lake)


LATE_SQL = f"""WITH {POLLED_SQL},
asked AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-15 12:00:00', '2024-01-15T12:00:00+00:00'),
                                (TIMESTAMP '2024-01-31', '2024-01-31T00:00:00+00:00')) t(known_at, as_of))
SELECT as_of, m.product, interval_start, series, value
FROM means m JOIN polls p ON m.product = p.product AND m.fetched_at = p.fetched_at
JOIN asked ON m.fetched_at <= known_at
WHERE new_posting
QUALIFY row_number() OVER (PARTITION BY as_of, m.product, interval_start, series
  ORDER BY m.fetched_at DESC) = 1"""


def two_streams(spark, sf):
    """One lake fed by a stream over raw files and one over landed responses, each with a progress
    of its own."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    responses = polled_responses(spark, sf)
    lake.keep_raw(responses.where(F.col("fetched_at") < AS_OF))
    lake.land_responses(responses.where(F.col("fetched_at") >= AS_OF), "landing")
    for landed in (False, True):
        where = shared_folder(spark, "progress")
        ingest(lake, products(), where, unit="batch", landed=landed)
    rows = lake.curated()
    return plain(rows.select("product", "interval_start", "posted_at", "series", "value", "source"))


def raw_files(spark, sf):
    """Responses kept as files, scanned with what their names and bodies say."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.keep_raw(daily_responses(spark, sf))
    lake.keep_raw(daily_responses(spark, sf).withColumn("body", F.lit("[]")))  # never replaces one
    found = _values(spark, lake.raw_files())
    return plain(found.select("product", "fetched_at", "rows", "dropped", "problem"))


def _answers(lake):
    """What was known at two times, from a lake."""
    answers = None
    for as_of in (AS_OF, NOW):
        known = snapshot(lake.curated().drop("posting"), BASE, BEYOND, as_of=as_of, max_days=None)
        known = known.select(
            F.lit(as_of.isoformat()).alias("as_of"), "product", "interval_start", "series", "value"
        )
        answers = known if answers is None else answers.unionByName(known)
    return plain(answers)


def late_ingest_direct(spark, sf):
    """The later half curated first, the earlier one after it, without streams: bodies are read
    again from where they were landed."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    responses = polled_responses(spark, sf)
    lake.land_responses(responses, "landing")
    for name, half in (("b", F.col("fetched_at") >= AS_OF), ("a", F.col("fetched_at") < AS_OF)):
        curate_live(lake, products(), responses.where(half), name, unit="batch")
    return _answers(lake)


def relanded(spark, sf):
    """A batch landed twice, the second time with other bodies for one product: all are kept."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    responses = daily_responses(spark, sf)
    other = F.when(F.col("product") == "click", F.lit("[]")).otherwise(F.col("body"))
    lake.land_responses(responses, "landing")
    lake.land_responses(responses.withColumn("body", other), "landing")
    return lake.responses().groupBy("product").agg(
        F.count("*").alias("bodies"), F.count_if(F.col("body") == "[]").alias("empty")
    )


RELANDED_SQL = """SELECT event_type AS product,
  count(DISTINCT date_trunc('day', ts)) * CASE event_type WHEN 'click' THEN 2 ELSE 1 END AS bodies,
  CASE event_type WHEN 'click' THEN count(DISTINCT date_trunc('day', ts)) ELSE 0 END AS empty
FROM events GROUP BY event_type"""


def _spoiled(spark, sf):
    """Daily responses, those of every eighth day with another time unit."""
    wrong = F.replace(F.col("body"), F.lit('"unixtime"'), F.lit('"iso8601"'))
    body = F.when(F.dayofmonth("fetched_at") % 8 == 1, wrong).otherwise(F.col("body"))
    return daily_responses(spark, sf).withColumn("body", body)


def run_summary(spark, sf):
    """What a batch did, per product: responses, postings, rows, and what it refused."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    done = curate_live(lake, products(), _spoiled(spark, sf), "b0", unit="batch")
    return done.select("product", "kind", "responses", "postings", "unchanged", "rows", "dropped", "days", "quarantined")


RUN_SUMMARY_SQL = f"""WITH {SUMMARY_PARTS},
good AS (SELECT *, hash_of IS DISTINCT FROM lag(hash_of) OVER (PARTITION BY product ORDER BY fetched_at) AS new
  FROM summed WHERE day(fetched_at) % 8 <> 1),
bad AS (SELECT product, count(*) AS quarantined FROM summed WHERE day(fetched_at) % 8 = 1 GROUP BY product)
SELECT product, 'live' AS kind, count(*) AS responses, count(*) FILTER (new) AS postings,
  count(*) FILTER (NOT new) AS unchanged, CAST(sum(rows) FILTER (new) AS BIGINT) AS rows,
  CAST(sum(144 - rows) FILTER (new) AS BIGINT) AS dropped,
  count(*) FILTER (new AND rows > 0) AS days, any_value(quarantined) AS quarantined
FROM good JOIN bad USING (product) GROUP BY product"""


def quarantine_report(spark, sf):
    """Each refused response with the reason."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    curate_live(lake, products(), _spoiled(spark, sf), "b0", unit="batch")
    return plain(quarantined(lake, "b0").select("product", "kind", "fetched_at", "problem"))


QUARANTINE_SQL = """SELECT DISTINCT event_type AS product, 'live' AS kind,
  date_trunc('day', ts) + INTERVAL 1 DAY AS fetched_at, 'time is not unixtime for n1' AS problem
FROM events WHERE day(date_trunc('day', ts) + INTERVAL 1 DAY) % 8 = 1"""


def freshness_report(spark, sf):
    """Age of each product's newest posting, from the log of a lake."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    curate_live(lake, products(), polled_responses(spark, sf), "b0", unit="batch")
    return plain(report.freshness_report(lake, products(), NOW))


FRESHNESS_REPORT_SQL = f"""WITH {POLLED_SQL},
n AS (SELECT product, max(fetched_at) AS last_posted_at FROM polls WHERE new_posting GROUP BY product)
SELECT product, {STALE_AFTER}::DOUBLE AS stale_after_min, last_posted_at,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_posted_at)) / 6e7 AS age_minutes,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_posted_at)) / 6e7 > {STALE_AFTER} AS stale,
  TIMESTAMP '2024-01-31' AS checked_at FROM n"""


def manifest_files(spark, sf):
    """Manifests written for readers that look for files, scanned back."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    none = lake.manifests()
    curate_live(lake, products(), polled_responses(spark, sf), "b0", unit="batch")
    report.publish_manifests(lake, products())
    found = lake.manifests().unionByName(none)
    return plain(
        found.select(
            "product", "model", "schema_version", "last_posted_at", "last_checked_at", "rows",
            F.array_join("partitions", ",").alias("partitions"),
        )
    )


MANIFEST_FILES_SQL = f"""WITH {POLLED_SQL}
SELECT p.product, 'events' AS model, 1 AS schema_version, p.fetched_at AS last_posted_at,
  last_checked_at, n AS rows, CASE WHEN n > 0 THEN '2024-02-01' ELSE '' END AS partitions
FROM polls p JOIN (SELECT product, max(fetched_at) AS last_checked_at FROM polls GROUP BY product) c
  ON p.product = c.product
WHERE new_posting
QUALIFY row_number() OVER (PARTITION BY p.product ORDER BY p.fetched_at DESC) = 1"""


def curated_lake(spark, sf):
    """The whole job: publish changed polls, then read the newest value of everything."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    curate_live(lake, products(), daily_responses(spark, sf), "all", unit="batch")
    rows = snapshot(lake.curated().drop("posting"), BASE.replace(month=1), BEYOND, as_of=BEYOND, max_days=None)
    return plain(
        rows.select("product", "interval_start", "series", F.round("value", 6).alias("value"))
    )


CURATED_LAKE_SQL = f"""WITH {DAILY_SQL}
SELECT product, interval_start, concat(variable, ':', zone) AS series,
  round(avg(value), 6) AS value
FROM zoned GROUP BY product, interval_start, variable, zone HAVING count(*) = 2"""


def previous_runs_lake(spark, sf):
    """Two lead days per hour from backfilled responses, written, logged and read back."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    curate_previous_runs(lake, products(backfill=LEADS), _past(spark, sf), "backfill")
    return _backfilled(lake)


def raw_previous_runs(spark, sf):
    """The same responses kept as files under the names of previous runs, found and ingested."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.keep_raw(_past(spark, sf))
    where = shared_folder(spark, "progress")
    ingest(lake, products(backfill=LEADS), where, kind=PREVIOUS_RUNS)
    return _backfilled(lake)


class _DiesOnce(Lake):
    """A lake whose first write of postings fails, as if the job were lost there."""

    alive = False

    def write_postings(self, rows):
        if not self.alive:
            self.alive = True
            raise OSError("lost")
        super().write_postings(rows)


def failed_runs(spark, sf):
    """What each run of two streams fails for: its own refused responses, all of them, also after a
    run that died between refusing and publishing."""
    lake = _DiesOnce(spark, shared_folder(spark, "lake"))
    spoiled = _spoiled(spark, sf)
    lake.keep_raw(spoiled.where("product IN ('click', 'view')"))
    lake.land_responses(spoiled.where("product NOT IN ('click', 'view')"), "landing")
    files, table = shared_folder(spark, "progress"), shared_folder(spark, "progress")
    found = None
    runs = [("files", files, False), ("table", table, True), ("replay", files, False), ("idle", table, True)]
    for name, where, landed in runs:
        refused = ()
        try:
            ingest(lake, products(), where, unit="batch", landed=landed)
        except QuarantinedError as error:
            refused = error.batches
        except StreamingQueryException:
            refused = None  # died
        if refused:
            mine = lake.quarantine().where(F.col("batch").isin(list(refused)))
            mine = mine.select(F.lit(name).alias("run"), "product", "fetched_at", "problem")
            found = mine if found is None else found.unionByName(mine)
    return plain(found)


FAILED_RUNS_SQL = """SELECT DISTINCT CASE WHEN event_type IN ('click', 'view') THEN 'replay' ELSE 'table' END AS run,
  event_type AS product, date_trunc('day', ts) + INTERVAL 1 DAY AS fetched_at,
  'time is not unixtime for n1' AS problem
FROM events WHERE day(date_trunc('day', ts) + INTERVAL 1 DAY) % 8 = 1"""


def previous_runs_refetched(spark, sf):
    """An older fetch of the same days, with other values, arrives last: the newer one stands."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    specs = products(backfill=LEADS)
    older = _past(spark, sf, more=500).withColumn(
        "fetched_at", F.col("fetched_at") - F.expr("INTERVAL 1 HOUR")
    )
    curate_previous_runs(lake, specs, _past(spark, sf), "first")
    curate_previous_runs(lake, specs, older, "second")
    return _backfilled(lake)


LEADS = Backfill(lead_days=(1, 2))


def _backfilled(lake):
    rows = lake.curated()
    return plain(
        rows.select(
            "product", "interval_start", "posted_at", "source", "series",
            F.round("value", 6).alias("value"),
        )
    )


def _past(spark, sf, more=0):
    """Daily responses as previous runs, each value raised by its lead, and ``more``."""
    past = daily_responses(spark, sf)
    shape = (
        "array<struct<latitude: double, longitude: double, hourly_units: map<string, string>,"
        " hourly: map<string, array<double>>>>"
    )

    def by_lead(block, raised):
        """Each variable once per lead day, its value raised by the lead."""
        parts = [F.map_filter(block, lambda name, _: name == "time")]
        for n in LEADS.lead_days:
            for name in UNITS:
                column = raised(F.try_element_at(block, F.lit(name)), n)
                parts.append(F.create_map(F.lit(f"{name}_previous_day{n}"), column))
        return F.map_concat(*parts)

    entries = F.transform(
        F.from_json("body", shape),
        lambda e: e.withField(
            "hourly_units", by_lead(e["hourly_units"], lambda unit, _: unit)
        ).withField(
            "hourly", by_lead(e["hourly"], lambda column, n: F.transform(column, lambda v: v + n + more))
        ),
    )
    day = F.to_date(F.col("fetched_at") - F.expr("INTERVAL 1 DAY"))
    return past.withColumns(
        {"kind": F.lit(PREVIOUS_RUNS), "first": day, "last": day, "body": F.to_json(entries)}
    )


PREVIOUS_RUNS_SQL = f"""WITH {DAILY_SQL}
SELECT product, interval_start, interval_start - n * INTERVAL 1 DAY + INTERVAL 1 HOUR AS posted_at,
  'previous_runs' AS source, concat(variable, ':', zone) AS series, round(avg(value) + n, 6) AS value
FROM zoned, (VALUES (1), (2)) l(n)
GROUP BY product, interval_start, variable, zone, n HAVING count(*) = 2"""

CASES = {
    "curated_rows": (curated_rows, CURATED_SQL),
    "reweighted_rows": (reweighted_rows, REWEIGHTED_SQL),
    "response_summary": (response_summary, SUMMARY_SQL),
    "response_drift": (response_drift, DRIFT_SQL),
    "response_times": (response_times, TIMES_SQL),
    "response_trim": (response_trim, TRIM_SQL),
    "response_roundtrip": (response_roundtrip, ROUNDTRIP_SQL),
    "zone_mean": (zone_mean, ZONE_MEAN_SQL),
    "poll_changes": (
        poll_changes,
        f"WITH {FLAG_SQL} SELECT product, fetched_at, digest, new_posting FROM marked",
    ),
    "latest_manifest": (latest_manifest, MANIFEST_SQL),
    "freshness": (freshness, FRESHNESS_SQL),
    "streaming_ingest": (streaming_ingest, STREAM_SQL),
    "late_ingest": (late_ingest, LATE_SQL),
    "curated_lake": (curated_lake, CURATED_LAKE_SQL),
    "previous_runs_lake": (previous_runs_lake, PREVIOUS_RUNS_SQL),
    "raw_previous_runs": (raw_previous_runs, PREVIOUS_RUNS_SQL),
    "failed_runs": (failed_runs, FAILED_RUNS_SQL),
    "previous_runs_refetched": (previous_runs_refetched, PREVIOUS_RUNS_SQL),
    "two_streams": (two_streams, STREAM_SQL),
    "late_ingest_direct": (late_ingest_direct, LATE_SQL),
    "relanded": (relanded, RELANDED_SQL),
    "raw_files": (
        raw_files,
        f"""WITH {SUMMARY_PARTS} SELECT product, fetched_at, CAST(rows AS INTEGER) AS rows,
          CAST(144 - rows AS INTEGER) AS dropped, CAST(NULL AS VARCHAR) AS problem FROM summed""",
    ),
    "run_summary": (run_summary, RUN_SUMMARY_SQL),
    "quarantine_report": (quarantine_report, QUARANTINE_SQL),
    "manifest_files": (manifest_files, MANIFEST_FILES_SQL),
    "freshness_report": (freshness_report, FRESHNESS_REPORT_SQL),
}
