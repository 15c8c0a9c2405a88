"""Point-in-time reads, as-of joins and version comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.inputs import (
    AS_OF,
    BEYOND,
    END,
    FIRST,
    LAKE_SQL,
    START,
    events,
    lake,
    plain,
    table,
    valid_hour,
)
from hindcast.operators import checks
from hindcast.operators.asof import asof_join, multi_snapshot
from hindcast.operators.reads import postings, snapshot, visible
from hindcast.operators.sets import excess, union_by_name
from hindcast.operators.vintages import (
    join_zone_series,
    lead_table,
    overlap_join,
    revisions,
    unpivot_leads,
    with_units,
)

WINDOW_SQL = """interval_start >= TIMESTAMP '2024-01-14' AND interval_start < TIMESTAMP '2024-01-18'
  AND posted_at <= TIMESTAMP '2024-01-15 12:00:00'"""
RANK_SQL = """QUALIFY row_number() OVER (PARTITION BY interval_start, series
  ORDER BY posted_at DESC, ingested_at DESC) = 1"""
SNAPSHOT_SQL = "SELECT interval_start, interval_minutes, series, value, posted_at FROM lake WHERE "


def _snapshot(**cuts):
    return lambda spark, sf: plain(snapshot(lake(spark, sf), START, END, as_of=AS_OF, **cuts))


def _snapshot_sql(cut="true"):
    return f"WITH {LAKE_SQL} {SNAPSHOT_SQL} {WINDOW_SQL} AND {cut} {RANK_SQL}"


def snapshot_whole(spark, sf):
    """Every valid hour, as known in the middle of the month."""
    return plain(snapshot(lake(spark, sf), FIRST, BEYOND, as_of=AS_OF, max_days=None))


def postings_read(spark, sf):
    return plain(postings(lake(spark, sf), START, END, as_of=AS_OF))


def postings_whole(spark, sf):
    return plain(postings(lake(spark, sf), FIRST, BEYOND, as_of=BEYOND, max_days=None))


def asof_multi(spark, sf):
    """A snapshot at noon of every day, each of the two days that follow."""
    noon = F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOUR")
    decisions = events(spark, sf).select(noon.alias("decision_at")).distinct().withColumns(
        {
            "valid_from": F.col("decision_at"),
            "valid_to": F.col("decision_at") + F.expr("INTERVAL 2 DAY"),
        }
    )
    found = multi_snapshot(decisions, lake(spark, sf))
    return plain(
        found.select("decision_at", "interval_start", "series", "posted_at", "value", "source")
    )


ASOF_MULTI_SQL = f"""WITH {LAKE_SQL},
d AS (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR AS decision_at FROM events)
SELECT decision_at, interval_start, series, posted_at, value, source
FROM d JOIN lake ON interval_start >= decision_at AND interval_start < decision_at + INTERVAL 2 DAY
  AND posted_at <= decision_at
QUALIFY row_number() OVER (PARTITION BY decision_at, interval_start, series
  ORDER BY posted_at DESC, ingested_at DESC) = 1"""


def asof_join_left(spark, sf):
    """Each event asks, when it happens, for its key's newest version; ties count as known."""
    decisions = events(spark, sf).select(
        "event_id",
        valid_hour().alias("interval_start"),
        F.concat("event_type", F.lit(":Z"), F.col("user_id") % 8).alias("series"),
        F.col("ts").alias("decision_at"),
    )
    later = decisions.withColumn("decision_at", F.col("decision_at") + F.expr("INTERVAL 36 HOUR"))
    other = decisions.withColumn(
        "series", F.regexp_replace("series", "^[a-z]+", "click")
    )
    asked = union_by_name(
        decisions.withColumn("question", F.lit("own")),
        later.withColumn("question", F.lit("later")),
        other.withColumn("question", F.lit("click")),
    )
    found = asof_join(asked, lake(spark, sf), how="left")
    return plain(
        found.select(
            "question", "event_id", "interval_start", "series", "decision_at", "posted_at",
            "value", "source",
        )
    )


ASOF_JOIN_SQL = f"""WITH {LAKE_SQL},
d AS (
  SELECT event_id, interval_start, series, posted_at AS decision_at, 'own' AS question FROM b
  UNION ALL SELECT event_id, interval_start, series, posted_at + INTERVAL 36 HOUR, 'later' FROM b
  UNION ALL SELECT event_id, interval_start, regexp_replace(series, '^[a-z]+', 'click'), posted_at,
                   'click' FROM b),
v AS (SELECT * FROM lake QUALIFY row_number() OVER (
        PARTITION BY interval_start, series, posted_at ORDER BY ingested_at DESC) = 1)
SELECT question, event_id, d.interval_start, d.series, decision_at, v.posted_at, v.value, v.source
FROM d ASOF LEFT JOIN v ON d.interval_start = v.interval_start AND d.series = v.series
  AND d.decision_at >= v.posted_at"""


def asof_offgrid(spark, sf):
    """Decisions and valid times at 25 past the hour, read for 30 and for 90 minutes."""
    later = F.expr("INTERVAL 25 MINUTES")
    moved = lake(spark, sf).withColumn(
        "interval_start",
        F.when(F.col("series").like("%Z1"), F.col("interval_start") + later).otherwise(
            F.col("interval_start")
        ),
    )
    noon = F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOUR") + later
    decisions = events(spark, sf).select(noon.alias("decision_at")).distinct()
    decisions = decisions.withColumn("valid_from", F.col("decision_at") + F.expr("INTERVAL 11 HOUR"))
    decisions = decisions.select(
        "*", F.explode(F.array(*[F.expr(f"valid_from + INTERVAL {m} MINUTES") for m in (30, 90)])).alias("valid_to")
    )
    found = multi_snapshot(decisions, moved)
    return plain(found.select("decision_at", "interval_start", "series", "posted_at", "value"))


ASOF_OFFGRID_SQL = f"""WITH {LAKE_SQL},
moved AS (SELECT * REPLACE (CASE WHEN series LIKE '%Z1' THEN interval_start + INTERVAL 25 MINUTE
  ELSE interval_start END AS interval_start) FROM lake),
d AS (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 745 MINUTE AS decision_at FROM events)
SELECT decision_at, interval_start, series, posted_at, value
FROM d JOIN moved ON interval_start >= decision_at + INTERVAL 11 HOUR
  AND interval_start < decision_at + INTERVAL 11 HOUR + INTERVAL 90 MINUTE
  AND posted_at <= decision_at
QUALIFY row_number() OVER (PARTITION BY decision_at, interval_start, series
  ORDER BY posted_at DESC, ingested_at DESC, source DESC, value DESC) = 1"""


def _with_product(rows):
    """The zone as the product, so that business keys repeat between products."""
    parts = F.split("series", ":")
    return rows.withColumn("product", parts[1]).withColumn("series", parts[0])


def asof_products(spark, sf):
    """Decisions of one product, and of all, over a table of several."""
    versions = _with_product(lake(spark, sf))
    days = events(spark, sf).select(F.date_trunc("day", "ts").alias("valid_from")).distinct()
    days = days.select(
        (F.col("valid_from") - F.expr("INTERVAL 6 HOUR")).alias("decision_at"), "valid_from",
        (F.col("valid_from") + F.expr("INTERVAL 1 DAY")).alias("valid_to"),
    )
    one = multi_snapshot(days.withColumn("product", F.lit("Z5")), versions)
    both = union_by_name(
        one.withColumn("asked", F.lit("one")),
        multi_snapshot(days, versions).withColumn("asked", F.lit("all")),
    )
    return plain(both.select("asked", "decision_at", "product", "interval_start", "series", "posted_at", "value"))


ASOF_PRODUCTS_SQL = f"""WITH {LAKE_SQL},
v AS (SELECT split_part(series, ':', 2) AS product, split_part(series, ':', 1) AS kind, * FROM lake),
d AS (SELECT DISTINCT date_trunc('day', ts) AS valid_from FROM events),
f AS (SELECT valid_from - INTERVAL 6 HOUR AS decision_at, product, interval_start, kind AS series,
    posted_at, value
  FROM d JOIN v ON interval_start >= valid_from AND interval_start < valid_from + INTERVAL 1 DAY
    AND posted_at <= valid_from - INTERVAL 6 HOUR
  QUALIFY row_number() OVER (PARTITION BY valid_from, product, interval_start, kind
    ORDER BY posted_at DESC, ingested_at DESC, source DESC, value DESC) = 1)
SELECT 'all' AS asked, * FROM f UNION ALL SELECT 'one', * FROM f WHERE product = 'Z5'"""


def asof_nulls(spark, sf):
    """Versions without a stamp and decisions without an instant know and are known by nothing."""
    lost = (F.col("source") == "previous_runs") & F.col("series").like("error%")
    versions = lake(spark, sf).withColumn("posted_at", F.when(~lost, F.col("posted_at")))
    asked = events(spark, sf).select(
        "event_id",
        valid_hour().alias("interval_start"),
        F.concat("event_type", F.lit(":Z"), F.col("user_id") % 8).alias("series"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("decision_at"),
    )
    found = asof_join(asked, versions, how="left")
    return plain(found.select("event_id", "decision_at", "posted_at", "value"))


ASOF_NULLS_SQL = f"""WITH {LAKE_SQL},
d AS (SELECT event_id, interval_start, series,
  CASE WHEN event_id % 7 <> 0 THEN posted_at + INTERVAL 1 DAY END AS decision_at FROM b),
v AS (SELECT * FROM lake WHERE NOT (source = 'previous_runs' AND series LIKE 'error%')
  QUALIFY row_number() OVER (PARTITION BY interval_start, series, posted_at
    ORDER BY ingested_at DESC, source DESC, value DESC) = 1)
SELECT event_id, decision_at, v.posted_at, v.value
FROM d ASOF LEFT JOIN v ON d.interval_start = v.interval_start AND d.series = v.series
  AND d.decision_at >= v.posted_at"""


def snapshots_second_clock(spark, sf):
    """A snapshot per day from what the system held at one time, of one source."""
    rows = visible(
        lake(spark, sf), FIRST, BEYOND, as_of=BEYOND, known_to_system_at=AS_OF,
        sources=["previous_runs"], max_days=None,
    )
    days = events(spark, sf).select(F.date_trunc("day", "ts").alias("decision_at")).distinct()
    days = days.select(
        "decision_at", F.col("decision_at").alias("valid_from"),
        (F.col("decision_at") + F.expr("INTERVAL 3 DAY")).alias("valid_to"),
    )
    found = multi_snapshot(days, rows)
    return plain(found.select("decision_at", "interval_start", "series", "posted_at", "value"))


SNAPSHOTS_SECOND_CLOCK_SQL = f"""WITH {LAKE_SQL},
d AS (SELECT DISTINCT date_trunc('day', ts) AS decision_at FROM events)
SELECT decision_at, interval_start, series, posted_at, value
FROM d JOIN lake ON interval_start >= decision_at AND interval_start < decision_at + INTERVAL 3 DAY
  AND posted_at <= decision_at AND source = 'previous_runs'
  AND ingested_at <= TIMESTAMP '2024-01-15 12:00:00'
QUALIFY row_number() OVER (PARTITION BY decision_at, interval_start, series
  ORDER BY posted_at DESC, ingested_at DESC, source DESC, value DESC) = 1"""


def dup_posting_keys(spark, sf):
    """Keys repeated within a posting, per whether one source alone repeats them."""
    repeated = checks.repeated_keys(lake(spark, sf).withColumn("product", F.lit("events")))
    return repeated.agg(
        F.count("*").alias("tied"), F.count_if("same_source").alias("same_source")
    )


DUP_SQL = f"""WITH {LAKE_SQL}, g AS (
  SELECT interval_start, series, posted_at, count(*) AS n, max(m) AS m FROM (
    SELECT interval_start, series, posted_at, source,
           count(*) OVER (PARTITION BY interval_start, series, posted_at, source) AS m FROM lake)
  GROUP BY ALL HAVING count(*) > 1)
SELECT count(*) AS tied, count(*) FILTER (m > 1) AS same_source FROM g"""


def live_postings(spark, sf):
    return checks.live_postings(lake(spark, sf).withColumn("product", F.lit("events")))


def late_rows(spark, sf):
    rows = lake(spark, sf)
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("posted_at") > F.col("ingested_at")).alias("late"),
        F.count_if(checks.any_null(rows.columns)).alias("nulls"),
    )


def lead_unpivot(spark, sf):
    """Seven lead columns per event, as a wide previous-runs response has them."""
    leads = [f"{name}_previous_day{n}" for n in range(1, 8) for name in ("amount",)]
    wide = events(spark, sf).select(
        "event_id",
        F.date_trunc("hour", "ts").alias("interval_start"),
        *[(F.col("value") + n).alias(column) for n, column in enumerate(leads, 1)],
    )
    return plain(unpivot_leads(wide, ["event_id", "interval_start"], leads))


LEAD_UNPIVOT_SQL = """SELECT event_id, date_trunc('hour', ts) AS interval_start, 'amount' AS variable,
  CAST(n AS INTEGER) AS lead,
  date_trunc('hour', ts) - n * INTERVAL 1 DAY + INTERVAL 60 MINUTE AS posted_at, value + n AS value
FROM events, range(1, 8) r(n)"""


def lead_pivot(spark, sf):
    """Per valid hour and series, what was predicted on each of the last two days before it."""
    table_ = lead_table(lake(spark, sf), [1, 2, 3])
    return plain(table_)


LEAD_PIVOT_SQL = f"""WITH {LAKE_SQL}, l AS (
  SELECT *, CAST(ceil((epoch_us(interval_start) - epoch_us(posted_at) + 3600000000) / 86400000000.0)
           AS INTEGER) AS lead FROM lake),
n AS (SELECT * FROM l WHERE lead IN (1, 2, 3) QUALIFY row_number() OVER (
        PARTITION BY interval_start, series, lead ORDER BY posted_at DESC, ingested_at DESC) = 1)
SELECT interval_start, series, max(value) FILTER (lead = 1) AS lead_1d,
  max(value) FILTER (lead = 2) AS lead_2d, max(value) FILTER (lead = 3) AS lead_3d
FROM n GROUP BY ALL"""


def revision_sizes(spark, sf):
    moved = revisions(lake(spark, sf))
    return plain(
        moved.select(
            "interval_start", "series", "posted_at", "value", "previous",
            F.round("change", 2).alias("change"),
        )
    )


REVISIONS_SQL = f"""WITH {LAKE_SQL}, v AS (
  SELECT * FROM lake QUALIFY row_number() OVER (
    PARTITION BY interval_start, series, posted_at ORDER BY ingested_at DESC) = 1)
SELECT interval_start, series, posted_at, value, lag(value) OVER w AS previous,
  round(value - lag(value) OVER w, 2) AS change
FROM v WINDOW w AS (PARTITION BY interval_start, series ORDER BY posted_at)"""


def zone_join(spark, sf):
    """Forecasts against what happened in the same hour and zone; purchases describe the hour
    before their stamp."""
    actual = events(spark, sf).groupBy(
        F.date_trunc("hour", "ts").alias("interval_start"),
        F.concat(F.lit("Z"), F.col("user_id") % 8).alias("zone"),
    ).agg(F.count("*").alias("actual"))
    newest = snapshot(lake(spark, sf), FIRST, BEYOND, as_of=BEYOND, max_days=None)
    joined = join_zone_series(newest, actual, preceding=["purchase"])
    return plain(joined.select("interval_start", "zone", "series", "value", "actual"))


ZONE_JOIN_SQL = f"""WITH {LAKE_SQL},
a AS (SELECT date_trunc('hour', ts) AS interval_start, concat('Z', user_id % 8) AS zone,
             count(*) AS actual FROM events GROUP BY ALL),
s AS (SELECT * FROM lake {RANK_SQL}),
f AS (SELECT CASE WHEN series LIKE 'purchase:%' THEN interval_start - INTERVAL 1 HOUR
             ELSE interval_start END AS interval_start, split_part(series, ':', 2) AS zone, series,
             value FROM s)
SELECT f.interval_start, f.zone, series, value, actual FROM f JOIN a USING (interval_start, zone)"""


def units(spark, sf):
    """Rows per unit, with units looked up by variable."""
    catalog = spark.range(1).select(
        F.explode(
            F.create_map(*[F.lit(x) for x in ("click", "1", "error", "1", "purchase", "EUR")])
        ).alias("variable", "unit")
    )
    rows = with_units(lake(spark, sf), catalog)
    return rows.groupBy("variable", "unit").agg(F.count("*").alias("rows"))


UNITS_SQL = f"""WITH {LAKE_SQL}, u AS (
  SELECT * FROM (VALUES ('click', '1'), ('error', '1'), ('purchase', 'EUR')) t(variable, unit))
SELECT v.variable, unit, count(*) AS rows
FROM (SELECT split_part(series, ':', 1) AS variable FROM lake) v LEFT JOIN u USING (variable)
GROUP BY ALL"""


def union_all(spark, sf):
    """Live and backfilled rows put together by name, one side without a source column."""
    rows = lake(spark, sf)
    live = rows.where("source = 'live'").drop("source")
    past = rows.where("source = 'previous_runs'").select(*reversed(rows.columns))
    whole = union_by_name(live, past)
    return whole.groupBy("source").agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total")
    )


UNION_SQL = f"""WITH {LAKE_SQL}, u AS (
  SELECT * EXCLUDE (source) FROM lake WHERE source = 'live'
  UNION ALL BY NAME SELECT * FROM lake WHERE source = 'previous_runs')
SELECT source, count(*) AS rows, round(sum(value), 2) AS total FROM u GROUP BY ALL"""


def multiset_except(spark, sf):
    """Order lines that occur more often by part than all returned ones do."""
    lines = table(spark, sf, "lineitem")
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    return excess(lines.select(*columns), lines.where("l_returnflag = 'R'").select(*columns))


EXCEPT_SQL = """WITH a AS (
  SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem),
d AS (SELECT *, 1 AS n FROM a UNION ALL SELECT *, -1 FROM a WHERE l_returnflag = 'R')
SELECT l_returnflag, l_linestatus, l_quantity, l_discount, CAST(sum(n) AS BIGINT) AS surplus
FROM d GROUP BY ALL HAVING sum(n) > 0"""

POSTINGS_SQL = """SELECT interval_start, interval_minutes, series, value, posted_at, ingested_at,
  source FROM lake WHERE """


def _hours_and_quarters(spark, sf):
    """Hourly sums per event type, and means of quarters of an hour that begin five minutes late."""
    e = events(spark, sf)
    value = F.round(F.col("value") * 100).cast("long")
    hours = e.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("interval_start"))
    hours = hours.agg((F.sum(value) / 100).alias("value")).withColumn("interval_minutes", F.lit(60))
    quarter = F.floor((F.unix_seconds("ts") - 300) / 900) * 900 + 300
    quarters = e.groupBy(F.col("event_type").alias("series"), F.timestamp_seconds(quarter).alias("interval_start"))
    quarters = quarters.agg((F.sum(value) / 100).alias("value")).withColumn("interval_minutes", F.lit(15))
    return hours, quarters


def resolutions(spark, sf):
    """Each hour with the mean of the quarters that overlap it, weighted by shared minutes."""
    hours, quarters = _hours_and_quarters(spark, sf)
    found = overlap_join(hours, quarters, ["series"], bin_minutes=90)
    return plain(found.withColumn("other_value", F.round("other_value", 6)))


RESOLUTIONS_SQL = """WITH e AS (SELECT event_type AS series, ts, CAST(round(value * 100) AS BIGINT) AS v FROM events),
h AS (SELECT series, date_trunc('hour', ts) AS interval_start, sum(v) / 100 AS value, 60 AS interval_minutes
  FROM e GROUP BY ALL),
q AS (SELECT series, time_bucket(INTERVAL 15 MINUTE, ts - INTERVAL 5 MINUTE) + INTERVAL 5 MINUTE AS begin,
  sum(v) / 100 AS value FROM e GROUP BY ALL),
p AS (SELECT h.series, h.interval_start, q.value, (least(epoch_us(h.interval_start) + 3600000000,
    epoch_us(q.begin) + 900000000) - greatest(epoch_us(h.interval_start), epoch_us(q.begin))) / 6e7 AS shared
  FROM h JOIN q ON h.series = q.series AND q.begin < h.interval_start + INTERVAL 1 HOUR
    AND q.begin + INTERVAL 15 MINUTE > h.interval_start)
SELECT h.series, h.interval_start, any_value(h.value)::DOUBLE AS value, any_value(interval_minutes) AS interval_minutes,
  round(sum(p.value * shared) / sum(shared), 6) AS other_value, coalesce(sum(shared), 0) AS shared_minutes
FROM h LEFT JOIN p ON h.series = p.series AND h.interval_start = p.interval_start
GROUP BY h.series, h.interval_start"""

CASES = {
    "resolutions": (resolutions, RESOLUTIONS_SQL),
    "snapshot": (_snapshot(), _snapshot_sql()),
    "snapshot_live": (_snapshot(sources=["live"]), _snapshot_sql("source = 'live'")),
    "snapshot_second_clock": (
        _snapshot(known_to_system_at=AS_OF),
        _snapshot_sql("ingested_at <= TIMESTAMP '2024-01-15 12:00:00'"),
    ),
    "snapshot_like": (
        _snapshot(series=["click:*", "view:Z3"]),
        _snapshot_sql("(series LIKE 'click:%' OR series = 'view:Z3')"),
    ),
    "snapshot_whole": (
        snapshot_whole,
        f"WITH {LAKE_SQL} {SNAPSHOT_SQL} posted_at <= TIMESTAMP '2024-01-15 12:00:00' {RANK_SQL}",
    ),
    "postings": (postings_read, f"WITH {LAKE_SQL} {POSTINGS_SQL} {WINDOW_SQL}"),
    "postings_whole": (postings_whole, f"WITH {LAKE_SQL} {POSTINGS_SQL} true"),
    "asof_multi": (asof_multi, ASOF_MULTI_SQL),
    "asof_offgrid": (asof_offgrid, ASOF_OFFGRID_SQL),
    "asof_products": (asof_products, ASOF_PRODUCTS_SQL),
    "asof_nulls": (asof_nulls, ASOF_NULLS_SQL),
    "snapshots_second_clock": (snapshots_second_clock, SNAPSHOTS_SECOND_CLOCK_SQL),
    "asof_join": (asof_join_left, ASOF_JOIN_SQL),
    "dup_posting_keys": (dup_posting_keys, DUP_SQL),
    "live_postings": (
        live_postings,
        f"""WITH {LAKE_SQL} SELECT 'events' AS product, count(DISTINCT posted_at) AS n
            FROM lake WHERE source = 'live'""",
    ),
    "late_rows": (
        late_rows,
        f"""WITH {LAKE_SQL} SELECT count(*) AS rows,
            count(*) FILTER (posted_at > ingested_at) AS late,
            count(*) FILTER (value IS NULL OR posted_at IS NULL OR ingested_at IS NULL
              OR interval_start IS NULL OR series IS NULL) AS nulls FROM lake""",
    ),
    "lead_unpivot": (lead_unpivot, LEAD_UNPIVOT_SQL),
    "lead_pivot": (lead_pivot, LEAD_PIVOT_SQL),
    "revisions": (revision_sizes, REVISIONS_SQL),
    "zone_join": (zone_join, ZONE_JOIN_SQL),
    "units": (units, UNITS_SQL),
    "union_all": (union_all, UNION_SQL),
    "multiset_except": (multiset_except, EXCEPT_SQL),
}
