"""A lake, polls and raw responses derived from the driver's tables with Spark."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.contract import LIVE
from hindcast.session import configure
from hindcast.settings import Backfill, Point, Product

EVENTS = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)
START = datetime(2024, 1, 14, tzinfo=UTC)
END = datetime(2024, 1, 18, tzinfo=UTC)
AS_OF = datetime(2024, 1, 15, 12, tzinfo=UTC)
FIRST = datetime(2024, 1, 1, tzinfo=UTC)
BEYOND = datetime(2024, 3, 1, tzinfo=UTC)
NOW = datetime(2024, 1, 31, tzinfo=UTC)
BASE = datetime(2024, 2, 1, tzinfo=UTC)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamps are declared as instants, so filters on them reach the Parquet scan."""
    return configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Instants as wall-clock UTC stamps, which is what the SQL side returns."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as curated rows; one in ten comes again, backfilled a day later under the same
    ``posted_at``."""
    e = events(spark, sf_dir)
    past = F.col("event_id") % 4 == 0
    delay = F.when(past, F.expr("INTERVAL 2 DAY")).otherwise(F.expr("INTERVAL 5 SECOND"))
    first = F.struct(
        (F.col("ts") + delay).alias("ingested_at"),
        F.when(past, "previous_runs").otherwise("live").alias("source"),
        F.col("value"),
    )
    again = F.struct(
        (F.col("ts") + delay + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
        F.lit("previous_runs").alias("source"),
        (F.col("value") + 1000).alias("value"),
    )
    versions = F.when(F.col("event_id") % 10 == 1, F.array(first, again)).otherwise(F.array(first))
    return e.select(
        valid_hour().alias("interval_start"),
        F.lit(60).alias("interval_minutes"),
        F.col("ts").alias("posted_at"),
        F.lit(1).alias("schema_version"),
        F.concat("event_type", F.lit(":Z"), F.col("user_id") % 8).alias("series"),
        F.inline(versions),
    )


def valid_hour() -> Column:
    day = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
    return day + F.make_dt_interval(hours=F.col("user_id") % 24)


LAKE_SQL = """b AS (
  SELECT date_trunc('day', ts) + INTERVAL 1 DAY + (user_id % 24) * INTERVAL 1 HOUR
           AS interval_start,
         60 AS interval_minutes, ts AS posted_at,
         CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 2 DAY ELSE ts + INTERVAL 5 SECOND END
           AS ingested_at,
         CASE WHEN event_id % 4 = 0 THEN 'previous_runs' ELSE 'live' END AS source,
         1 AS schema_version,
         concat(event_type, ':Z', CAST(user_id % 8 AS VARCHAR)) AS series, value, event_id
  FROM events),
lake AS (
  SELECT interval_start, interval_minutes, posted_at, ingested_at, source, schema_version,
         series, value FROM b
  UNION ALL
  SELECT interval_start, interval_minutes, posted_at, ingested_at + INTERVAL 1 DAY,
         'previous_runs', schema_version, series, value + 1000 FROM b WHERE event_id % 10 = 1)"""


# -- raw responses ---------------------------------------------------------------------------

ZONES = {
    "North": [Point("n1", 10.0, 20.0), Point("n2", 11.0, 21.0, 3.0)],
    "South": [Point("s1", 12.0, 22.0), Point("s2", 13.0, 23.0, 3.0)],
    "West": [Point("w1", 14.0, 24.0), Point("w2", 15.0, 25.0, 3.0)],
}
EQUAL_ZONES = {z: [Point(p.name, p.lat, p.lon) for p in points] for z, points in ZONES.items()}
UNITS = {"amount": "EUR", "events": "1"}
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def products(*, weighted: bool = False, backfill: Backfill | None = None) -> list[Product]:
    """One product per event type, with six points in three zones."""
    return [
        Product(
            key=key, name=key, model="events", variables=UNITS,
            zones=ZONES if weighted else EQUAL_ZONES, backfill=backfill,
        )
        for key in EVENT_TYPES
    ]


def daily_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event type and day: 24 hours of that day at six points. A point's hour
    without events has no value."""
    cells = (
        events(spark, sf_dir)
        .groupBy(
            F.col("event_type").alias("product"),
            F.date_trunc("day", "ts").alias("start"),
            (F.col("user_id") % 6).alias("pos"),
            F.hour("ts").alias("hour"),
        )
        .agg(
            F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / 100, 2).alias("amount"),
            F.count("*").cast("double").alias("events"),
        )
    )
    fetched = F.col("start") + F.expr("INTERVAL 1 DAY")
    return _bodies(cells.withColumn("fetched_at", fetched), 24)


def polled_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event type and day about the same four hours, with values coarse enough
    that many polls bring nothing new."""
    cells = (
        events(spark, sf_dir)
        .groupBy(
            F.col("event_type").alias("product"),
            F.date_trunc("day", "ts").alias("day"),
            (F.col("user_id") % 6).alias("pos"),
            F.floor(F.hour("ts") / 6).cast("int").alias("hour"),
        )
        .agg(F.floor(F.log2(F.count("*"))).cast("double").alias("events"))
        .withColumn("amount", F.col("events") / 2)
    )
    return _bodies(
        cells.withColumns(
            {
                "fetched_at": F.col("day") + F.expr("INTERVAL 1 DAY"),
                "start": F.lit(BASE).cast("timestamp"),
            }
        ).drop("day"),
        4,
    )


def _bodies(cells: DataFrame, hours: int) -> DataFrame:
    """Responses as JSON text, from cells of (product, fetched_at, start, pos, hour, values).

    The cells of one response number at most points x hours.
    """
    grouped = cells.groupBy("product", "fetched_at", "start").agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(F.col("pos") * hours + F.col("hour"), F.struct("amount", "events"))
            )
        ).alias("cells")
    )
    hour_list = F.sequence(F.lit(0), F.lit(hours - 1))
    times = F.transform(
        hour_list, lambda h: (F.unix_seconds("start") + h * 3600).cast("double")
    )

    def values(pos: Column, name: str) -> Column:
        return F.transform(
            hour_list, lambda h: F.try_element_at("cells", pos * hours + h.cast("long"))[name]
        )

    def entry(pos: Column) -> Column:
        return F.struct(
            (pos + 10.0).alias("latitude"),
            (pos + 20.0).alias("longitude"),
            F.create_map(
                F.lit("time"), F.lit("unixtime"),
                *[F.lit(x) for item in UNITS.items() for x in item],
            ).alias("hourly_units"),
            F.create_map(
                F.lit("time"), times,
                F.lit("amount"), values(pos, "amount"),
                F.lit("events"), values(pos, "events"),
            ).alias("hourly"),
        )

    body = F.to_json(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long")), entry))
    key = F.concat_ws("/", "product", F.date_format("fetched_at", "yyyy-MM-dd"))
    return grouped.select(
        "product",
        F.lit(LIVE).alias("kind"),
        "fetched_at",
        F.lit(None).cast("date").alias("first"),
        F.lit(None).cast("date").alias("last"),
        key.alias("raw_key"),
        body.alias("body"),
    )


DAILY_SQL = """cells AS (
  SELECT event_type AS product, date_trunc('day', ts) AS start, user_id % 6 AS pos,
         hour(ts) AS hour,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount,
         CAST(count(*) AS DOUBLE) AS events
  FROM events GROUP BY ALL),
points AS (
  SELECT product, start, start + INTERVAL 1 DAY AS fetched_at,
         start + hour * INTERVAL 1 HOUR AS interval_start, pos, v.variable AS variable,
         CASE v.variable WHEN 'amount' THEN amount ELSE events END AS value
  FROM cells, (VALUES ('amount'), ('events')) v(variable)),
zoned AS (
  SELECT *, CASE pos // 2 WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE 'West' END AS zone,
         CASE pos % 2 WHEN 0 THEN 1 ELSE 3 END AS weight
  FROM points)"""

POLLED_SQL = """cells AS (
  SELECT event_type AS product, date_trunc('day', ts) + INTERVAL 1 DAY AS fetched_at,
         user_id % 6 AS pos, hour(ts) // 6 AS hour, floor(log2(count(*))) AS events
  FROM events GROUP BY ALL),
zoned AS (
  SELECT product, fetched_at, TIMESTAMP '2024-02-01' + hour * INTERVAL 1 HOUR AS interval_start,
         concat(v.variable, ':',
                CASE pos // 2 WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE 'West' END) AS series,
         CASE v.variable WHEN 'amount' THEN events / 2.0 ELSE events END AS value
  FROM cells, (VALUES ('amount'), ('events')) v(variable)),
means AS (
  SELECT product, fetched_at, interval_start, series, CAST(avg(value) AS DOUBLE) AS value
  FROM zoned GROUP BY product, fetched_at, interval_start, series HAVING count(*) = 2),
digests AS (
  SELECT p.product, p.fetched_at,
         coalesce(string_agg(concat(interval_start, series, value), ',' ORDER BY interval_start, series), '') AS digest,
         count(value) AS n
  FROM (SELECT DISTINCT product, fetched_at FROM cells) p
  LEFT JOIN means m ON p.product = m.product AND p.fetched_at = m.fetched_at
  GROUP BY p.product, p.fetched_at),
polls AS (
  SELECT *, digest IS DISTINCT FROM lag(digest) OVER (PARTITION BY product ORDER BY fetched_at)
         OR row_number() OVER (PARTITION BY product ORDER BY fetched_at) = 1 AS new_posting
  FROM digests)"""
