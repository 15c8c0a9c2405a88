"""Verification, compaction, coverage, alarms and the catalog."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from acceptance.inputs import (
    AS_OF,
    BEYOND,
    FIRST,
    LAKE_SQL,
    NOW,
    events,
    lake,
    plain,
    table,
)
from acceptance.reads import POSTINGS_SQL, RANK_SQL, SNAPSHOT_SQL
from hindcast.functions.columns import stamp
from hindcast.operators import checks
from hindcast.operators.calendar import coverage_gaps as gaps
from hindcast.operators.calendar import latest_windows
from hindcast.operators.calendar import window_plan as plan
from hindcast.operators.changes import alarm_hours as alarms
from hindcast.operators.reads import postings, snapshot
from hindcast.plans.catalog import (
    expected_series,
    merge_entries,
    publish_catalog,
    variables,
    zone_points,
)
from hindcast.plans.compact import compact
from hindcast.plans.curate import land_forecast
from hindcast.plans.verify import verify_lake
from hindcast.reader import ForecastReader
from hindcast.session import shared_folder
from hindcast.settings import Point, Product
from hindcast.sources.lake import Lake
from hindcast.streaming.freshness import hourly_ages, hourly_alarms


def _catalogued(spark, sf):
    """A catalog that knows four of the five event types, in all zones."""
    seen = events(spark, sf).where("event_type <> 'signup'").agg(
        F.collect_set("event_type").alias("types"), F.collect_set(F.col("user_id") % 8).alias("ids")
    )
    zones = F.transform("ids", lambda i: F.concat(F.lit("Z"), i.cast("string")))
    return seen.select(
        F.lit("events").alias("product"),
        F.map_from_arrays("types", F.transform("types", lambda _: F.lit("1"))).alias("variables"),
        F.map_from_arrays(zones, zones).alias("zones"),
    )


def _named(spark, sf):
    return lake(spark, sf).withColumn("product", F.lit("events"))


def verify_report(spark, sf):
    return checks.verify(_named(spark, sf), expected_series(_catalogued(spark, sf)))


VERIFY_SQL = f"""WITH {LAKE_SQL},
u AS (SELECT DISTINCT series FROM lake WHERE series LIKE 'signup:%'),
t AS (SELECT interval_start, series, posted_at, count(*) AS n FROM lake GROUP BY ALL),
ts AS (SELECT interval_start, series, posted_at, source, count(*) AS n FROM lake GROUP BY ALL)
SELECT 'events' AS product, * FROM (
  SELECT 'rows' AS "check", count(*) AS n, CAST(NULL AS VARCHAR) AS sample FROM lake
  UNION ALL SELECT 'series', count(DISTINCT series), NULL FROM lake
  UNION ALL SELECT 'live_postings', count(DISTINCT posted_at), NULL FROM lake WHERE source = 'live'
  UNION ALL SELECT 'null_in_required_column', count(*) FILTER (value IS NULL), NULL FROM lake
  UNION ALL SELECT 'key_repeated_in_posting', count(*), NULL FROM t WHERE n > 1
  UNION ALL SELECT 'key_repeated_in_posting_and_source', count(*), NULL FROM ts WHERE n > 1
  UNION ALL SELECT 'series_not_in_catalog', (SELECT count(*) FROM u),
    (SELECT string_agg(series, ', ' ORDER BY series) FROM (FROM u ORDER BY series LIMIT 5))
  UNION ALL SELECT 'unknown_schema_version', 0, NULL
  UNION ALL SELECT 'posted_after_ingested', count(*) FILTER (posted_at > ingested_at), NULL FROM lake)"""


def verify_remembered(spark, sf):
    """A lake verified, added to, and verified again: only the days that changed are scanned."""
    kept = Lake(spark, shared_folder(spark, "lake"))
    rows = _units(spark, sf)
    early = F.col("posted_at") < AS_OF
    kept.write_postings(rows.where(early).repartition("date"))
    kinds = events(spark, sf).where("event_type <> 'signup'").select("event_type").distinct()
    collected = Product(
        key="events", name="events", model="events",
        variables={r.event_type: "1" for r in kinds.collect()},
        zones={f"Z{k}": [Point("p", 0.0, 0.0)] for k in range(8)},
    )
    publish_catalog(spark, kept.root, [collected], NOW)
    verify_lake(kept, remember=True)
    kept.write_postings(rows.where(~early).withColumn("posting", F.concat("posting", F.lit("-2"))).repartition("date"))
    return verify_lake(kept, remember=True)


def unknown_series(spark, sf):
    found = checks.unknown_series(_named(spark, sf), expected_series(_catalogued(spark, sf)))
    return found.select("series")


def compacted_snapshot(spark, sf):
    """Postings written in many units, merged in two runs, then read as if nothing happened."""
    kept = Lake(spark, shared_folder(spark, "lake"))
    block = F.date_trunc("hour", "posted_at")
    live = F.concat(F.lit("part-"), stamp(block - F.make_dt_interval(hours=F.hour("posted_at") % 6)))
    unit = F.when(F.col("source") == "live", live).otherwise(F.lit("previous-runs"))
    rows = _named(spark, sf).withColumns(
        {"date": F.to_date("interval_start"), "posting": unit}
    )
    kept.write_postings(rows.repartition("date"))
    now = NOW + timedelta(days=36500)
    first = compact(kept, now=now, max_partitions=20)
    if not first.stopped:
        raise AssertionError("the first run was meant to stop at its bound")
    compact(kept, now=now + timedelta(hours=2))
    units = kept.curated_files().select("date", "posting").distinct().groupBy("date").count()
    merged = kept.curated().join(units.where("count = 1"), "date", "left_semi")
    known = snapshot(merged.drop("product", "posting"), FIRST, BEYOND, as_of=AS_OF, max_days=None)
    return plain(known)


def _units(spark, sf):
    """Events with the day and the unit they would be posted in: six hours of polls, or a backfill."""
    block = F.date_trunc("hour", "posted_at")
    live = F.concat(F.lit("part-"), stamp(block - F.make_dt_interval(hours=F.hour("posted_at") % 6)))
    unit = F.when(F.col("source") == "live", live).otherwise(F.lit("previous-runs"))
    return _named(spark, sf).withColumns({"date": F.to_date("interval_start"), "posting": unit})


def flat_compacted_snapshot(spark, sf):
    """A lake of one file per posting and day, merged in two runs, new files in between, each day then
    one file."""
    kept = Lake(spark, shared_folder(spark, "lake"))
    rows = _units(spark, sf)
    early = F.col("posted_at") < AS_OF
    kept.write_flat(rows.where(early | (F.col("source") != "live")))
    now = NOW + timedelta(days=36500)
    compact(kept, now=now)
    kept.write_flat(rows.where(~early & (F.col("source") == "live")))
    compact(kept, now=now + timedelta(hours=2))
    files = kept.curated_files().groupBy("date").agg(F.count("*").alias("files"), F.max("posting").alias("name"))
    merged = kept.curated().join(files.where("files = 1 AND name LIKE 'merged-%'"), "date", "left_semi")
    known = snapshot(merged.drop("product", "posting"), FIRST, BEYOND, as_of=AS_OF, max_days=None)
    return plain(known)


def postings_while_merging(spark, sf):
    """Every version, read from a lake where merged units and what they replace lie side by side."""
    kept = Lake(spark, shared_folder(spark, "lake"))
    kept.write_flat(_units(spark, sf))
    before = kept.curated_files().count()
    compact(kept, now=NOW + timedelta(days=36500), delete_sources=False)
    if kept.curated_files().count() <= before:
        raise AssertionError("sources were meant to stay")
    rows = kept.curated().drop("product", "posting")
    return plain(postings(rows, FIRST, BEYOND, as_of=BEYOND, max_days=None))


def lake_snapshot(spark, sf):
    """The whole way: rows landed in a lake, its catalog published, and read through it."""
    kept = Lake(spark, shared_folder(spark, "lake"))
    land_forecast(kept, _named(spark, sf), "batch-load")
    collected = Product(
        key="events", name="events", model="events",
        variables={"click": "1", "purchase": "EUR"}, zones={"Z0": [Point("p", 0.0, 0.0)]},
    )
    publish_catalog(spark, kept.root, [collected], NOW)
    reader = ForecastReader(spark, kept.root)
    known = reader.snapshot(
        "events", FIRST, FIRST + timedelta(days=40), as_of=AS_OF, sources=["live"]
    )
    return plain(known)


def window_plan(spark, sf):
    """Backfill requests per event type, from its first to its last day, in weekly windows."""
    requests = events(spark, sf).groupBy(F.col("event_type").alias("product")).agg(
        F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")
    )
    return plan(requests.withColumn("size", F.length("product")))


WINDOW_PLAN_SQL = """WITH r AS (
  SELECT event_type AS product, CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last,
         CAST(length(event_type) AS INTEGER) AS size FROM events GROUP BY event_type)
SELECT product, CAST(first + i * size AS DATE) AS first,
  CAST(least(first + i * size + size - 1, last) AS DATE) AS last
FROM r, (SELECT CAST(range AS INTEGER) AS i FROM range(0, 400)) WHERE first + i * size <= last"""


def _fetched_windows(spark, sf):
    """A window of one to three days for every event, in very many small products."""
    day = F.to_date("ts")
    return events(spark, sf).select(
        F.concat("event_type", F.lit("-"), F.col("user_id") % 1000).alias("product"),
        day.alias("first"),
        F.date_add(day, (F.col("user_id") % 3).cast("int")).alias("last"),
        F.col("ts").alias("fetched_at"),
        F.col("event_id").alias("rows"),
        F.lit(0).alias("dropped"),
    )


WINDOWS_SQL = """w AS (
  SELECT concat(event_type, '-', user_id % 1000) AS product, CAST(ts AS DATE) AS first,
         CAST(CAST(ts AS DATE) + CAST(user_id % 3 AS INTEGER) AS DATE) AS last, ts AS fetched_at,
         event_id AS rows, 0 AS dropped
  FROM events)"""


def coverage(spark, sf):
    return plain(latest_windows(_fetched_windows(spark, sf)))


def coverage_gaps(spark, sf):
    """Days of the month no fetched window covers."""
    windows = _fetched_windows(spark, sf)
    requests = windows.select(
        "product", F.lit(FIRST.date()).alias("first"), F.lit(NOW.date()).alias("last")
    ).distinct()
    return gaps(requests, windows)


GAPS_SQL = f"""WITH {WINDOWS_SQL},
d AS (SELECT product, CAST(DATE '2024-01-01' + i AS DATE) AS day
      FROM (SELECT DISTINCT product FROM w), (SELECT CAST(range AS INTEGER) AS i FROM range(0, 31)))
SELECT product, day FROM d
WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.product = d.product AND d.day BETWEEN first AND last)"""


def _checks_made(spark, sf):
    """Every event as a check. Those of two days are an hour and a half late, so that there are
    hours without any."""
    late = F.when(F.dayofweek("ts") == 1, F.expr("INTERVAL 90 MINUTE")).otherwise(
        F.expr("INTERVAL 0 MINUTE")
    )
    return events(spark, sf).select(
        (F.col("ts") + late).alias("checked_at"), (F.col("value") * 2).alias("age_minutes")
    )


def alarm_hours(spark, sf):
    """Hours whose greatest age, or missing check, breaches twice in a row."""
    return plain(alarms(_checks_made(spark, sf), FIRST, NOW, threshold_min=240))


HOURLY_SQL = """SELECT CAST(date_trunc('hour', CASE WHEN dayofweek(ts) = 0 THEN ts + INTERVAL 90 MINUTE
    ELSE ts END) AS TIMESTAMP) AS hour, max(value * 2) AS max_age_minutes
  FROM events GROUP BY 1"""
ALARM_SQL = f"""WITH c AS ({HOURLY_SQL}),
h AS (SELECT TIMESTAMP '2024-01-01' + i * INTERVAL 1 HOUR AS hour FROM range(0, 720) t(i)),
b AS (SELECT hour, max_age_minutes, coalesce(max_age_minutes > 240, true) AS breach
      FROM h LEFT JOIN c USING (hour))
SELECT *, breach AND coalesce(lag(breach) OVER (ORDER BY hour), true) AS alarm FROM b"""


def streamed_alarms(spark, sf):
    """The alarm product by product, from a stream of checks with holes, as its hours end."""
    checks = events(spark, sf).select(
        F.col("event_type").alias("product"), F.col("ts").alias("checked_at"),
        (F.col("value") * 4).alias("age_minutes"),
    )
    folder = shared_folder(spark, "alarms")
    # Whole days are missing.
    checks.where(F.dayofweek("checked_at") != 1).write.parquet(f"{folder}/checks")
    stream = spark.readStream.schema(checks.schema).parquet(f"{folder}/checks")
    alarmed = hourly_alarms(stream, FIRST, threshold_min=240)
    alarmed.writeStream.option("checkpointLocation", f"{folder}/state").option(
        "path", f"{folder}/alarms"
    ).trigger(availableNow=True).start().awaitTermination()
    return plain(spark.read.schema(alarmed.schema).parquet(f"{folder}/alarms"))


STREAMED_SQL = """WITH e AS (SELECT event_type AS product, date_trunc('hour', ts) AS hour, value * 4 AS age
  FROM events WHERE dayofweek(ts) <> 0),
h AS (SELECT product, CAST(TIMESTAMP '2024-01-01' + i * INTERVAL 1 HOUR AS TIMESTAMP) AS hour
      FROM (SELECT DISTINCT product FROM e), range(0, 8784) t(i)
      WHERE TIMESTAMP '2024-01-01' + (i + 2) * INTERVAL 1 HOUR <= (SELECT max(hour) FROM e)),
b AS (SELECT product, hour, max(age) AS max_age_minutes, coalesce(max(age) > 240, true) AS breach
      FROM h LEFT JOIN e USING (product, hour) GROUP BY 1, 2)
SELECT *, breach AND coalesce(lag(breach) OVER (PARTITION BY product ORDER BY hour), true) AS alarm FROM b"""


def hourly_age(spark, sf):
    return plain(hourly_ages(_checks_made(spark, sf)))


def _regions(spark, sf, supplied):
    """A catalog entry per region: a variable per nation, a zone with a point per nation."""
    nations = table(spark, sf, "nation")
    if supplied:
        held = table(spark, sf, "supplier").where("s_acctbal > 9000").select(
            F.col("s_nationkey").alias("n_nationkey")
        )
        nations = nations.join(held, "n_nationkey", "left_semi")
    point = F.struct(
        F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"),
    )
    return (
        nations.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.lower("r_name").alias("product"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("n_name", F.lit("1")))).alias("variables"),
            F.array_sort(F.collect_list(point)).alias("points"),
        )
        .select(
            "product", F.lit("region").alias("name"), F.lit(60).alias("interval_minutes"),
            "variables", F.create_map(F.lit("whole"), F.col("points")).alias("zones"),
            F.lit(True).alias("live"),
        )
    )


def catalog_merge(spark, sf):
    """The next catalog: regions without a rich supplier are kept but no longer live."""
    merged = merge_entries(_regions(spark, sf, False), _regions(spark, sf, True))
    return merged.select(
        "product", "live", "changed", F.size("variables").alias("variables"),
        F.size(F.col("zones")["whole"]).alias("points"),
    )


CATALOG_SQL = """WITH n AS (
  SELECT lower(r_name) AS product, n_nationkey, n_nationkey IN (
    SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) AS kept
  FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT product, CAST(count(*) AS INTEGER) AS o, CAST(count(*) FILTER (kept) AS INTEGER) AS k
      FROM n GROUP BY product)
SELECT product, k > 0 AS live, o <> k AS changed, CASE WHEN k > 0 THEN k ELSE o END AS variables,
  CASE WHEN k > 0 THEN k ELSE o END AS points FROM c"""


def catalog_tables(spark, sf):
    """Expected series per product: each variable with each zone; with its unit and points."""
    entries = _regions(spark, sf, False)
    series = expected_series(entries).groupBy("product").agg(F.count("*").alias("series"))
    units = variables(entries).groupBy("product").agg(F.count("unit").alias("units"))
    points = zone_points(entries).groupBy("product").agg(
        F.count("*").alias("points"), F.max("pos").alias("last_pos")
    )
    return series.join(units, "product").join(points, "product")


CATALOG_TABLES_SQL = """SELECT lower(r_name) AS product, count(*) AS series, count(*) AS units,
  count(*) AS points, CAST(count(*) - 1 AS INTEGER) AS last_pos
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""

CASES = {
    "verify_report": (verify_report, VERIFY_SQL),
    "verify_remembered": (
        verify_remembered,
        f"{VERIFY_SQL} UNION ALL SELECT 'events', 'no_curated_files', 0, NULL UNION ALL SELECT 'events', 'missing_columns', 0, ''",
    ),
    "unknown_series": (
        unknown_series,
        f"WITH {LAKE_SQL} SELECT DISTINCT series FROM lake WHERE series LIKE 'signup:%'",
    ),
    "compacted_snapshot": (
        compacted_snapshot,
        f"WITH {LAKE_SQL} {SNAPSHOT_SQL} posted_at <= TIMESTAMP '2024-01-15 12:00:00' {RANK_SQL}",
    ),
    "flat_compacted_snapshot": (
        flat_compacted_snapshot,
        f"WITH {LAKE_SQL} {SNAPSHOT_SQL} posted_at <= TIMESTAMP '2024-01-15 12:00:00' {RANK_SQL}",
    ),
    "postings_while_merging": (postings_while_merging, f"WITH {LAKE_SQL} {POSTINGS_SQL} true"),
    "lake_snapshot": (
        lake_snapshot,
        f"""WITH {LAKE_SQL} {SNAPSHOT_SQL} posted_at <= TIMESTAMP '2024-01-15 12:00:00'
            AND source = 'live' {RANK_SQL}""",
    ),
    "window_plan": (window_plan, WINDOW_PLAN_SQL),
    "coverage": (
        coverage,
        f"""WITH {WINDOWS_SQL} SELECT * FROM w QUALIFY row_number() OVER (
            PARTITION BY product, first, last ORDER BY fetched_at DESC) = 1""",
    ),
    "coverage_gaps": (coverage_gaps, GAPS_SQL),
    "alarm_hours": (alarm_hours, ALARM_SQL),
    "streamed_alarms": (streamed_alarms, STREAMED_SQL),
    "hourly_ages": (
        hourly_age,
        HOURLY_SQL,
    ),
    "catalog_merge": (catalog_merge, CATALOG_SQL),
    "catalog_tables": (catalog_tables, CATALOG_TABLES_SQL),
}
