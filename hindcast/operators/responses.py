"""From a raw multi-point JSON response to zone values.

A response is one row and stays one row until its values are final: points are matched by
position, checked, averaged and digested with array expressions, so nothing is shuffled and a
product with very many responses is spread like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.contract import (
    INTERVAL_MINUTES,
    LIVE,
    MAX_SNAP_DEGREES,
    PREVIOUS_RUNS,
    SCHEMA_VERSION,
)
from hindcast.functions.columns import backfill_posted_at, stamp

BODY = """array<struct<latitude: double, longitude: double,
    hourly_units: map<string, string>, hourly: map<string, array<double>>>>"""

# The first thing wrong with one declared column ``c`` of entry ``e``.
COLUMN_PROBLEM = """
CASE
  WHEN try_element_at(e.hourly, c.name) IS NULL THEN concat(c.name, ' is missing')
  WHEN NOT try_element_at(e.hourly_units, c.name) <=> c.unit THEN
    concat(c.name, ' is in ', coalesce(try_element_at(e.hourly_units, c.name), 'no unit'),
           ', declared in ', c.unit)
END"""

UNDECLARED = "array_except(map_keys(e.hourly), array_append(columns.name, 'time'))"

# The first thing wrong with entry ``e``, which must be about point ``p``.
ENTRY_PROBLEM = f"""
CASE
  WHEN e IS NULL THEN concat('no readable entry for ', p.name)
  WHEN NOT coalesce(abs(e.latitude - p.lat) <= {MAX_SNAP_DEGREES}
                AND abs(e.longitude - p.lon) <= {MAX_SNAP_DEGREES}, false)
    THEN concat('location is not that of ', p.name)
  WHEN e.hourly IS NULL
    THEN concat('hourly values are missing or not numbers for ', p.name)
  WHEN size({UNDECLARED}) > 0
    THEN concat('undeclared variables in the response: ', array_join(array_sort({UNDECLARED}), ', '))
  WHEN exists(columns, c -> {COLUMN_PROBLEM} IS NOT NULL)
    THEN concat(get(filter(transform(columns, c -> {COLUMN_PROBLEM}), x -> x IS NOT NULL), 0),
                ' for ', p.name)
  WHEN NOT coalesce(try_element_at(e.hourly_units, 'time') = 'unixtime', false)
    THEN concat('time is not unixtime for ', p.name)
  WHEN coalesce(exists(try_element_at(e.hourly, 'time'), t -> t IS NULL), true)
    THEN concat('valid times are missing for ', p.name)
  WHEN NOT coalesce(
      try_element_at(e.hourly, 'time') = try_element_at(entries[0].hourly, 'time'), false)
    THEN concat('different valid times for ', p.name)
  WHEN exists(columns, c -> size(e.hourly[c.name]) <> size(e.hourly['time']))
    THEN concat('values and valid times differ in number for ', p.name)
END"""

# The first way a response differs from its declared layout, or null.
PROBLEM = f"""
CASE
  WHEN points IS NULL THEN 'product declares no such responses'
  WHEN entries IS NULL THEN 'response is neither an object nor a list'
  WHEN size(entries) <> size(points)
    THEN concat(size(entries), ' points in the response, ', size(points), ' requested')
  ELSE get(filter(zip_with(entries, points, (e, p) -> {ENTRY_PROBLEM}), x -> x IS NOT NULL), 0)
END"""

# Per zone ``z`` and declared column ``c``, valid times and the weighted mean of all the zone's
# points. Adding null gives null, so an hour with a missing point has no value and is left out.
# Points are added in order: the same input gives the same bits, which the digest relies on.
SERIES_VALUES = """
CASE WHEN problem IS NULL THEN
  flatten(transform(zones, z -> transform(columns, c -> named_struct(
    'series', concat_ws(':', c.variable, z.zone),
    'lead', c.lead,
    'pairs', filter(
      zip_with(
        entries[0].hourly['time'],
        aggregate(
          zip_with(z.positions, z.weights, (i, w) -> transform(
            entries[i].hourly[c.name],
            v -> CASE WHEN abs(v) < double('Infinity') THEN v * w END)),
          transform(entries[0].hourly['time'], t -> 0D),
          (total, member) -> zip_with(total, member, (a, b) -> a + b),
          total -> transform(total, a -> a / z.weight)),
        (t, v) -> named_struct('time', bigint(t), 'value', v)),
      pair -> pair.value IS NOT NULL)))))
END"""

REPEATED = """exists(series_values,
    s -> size(array_distinct(s.pairs.time)) < size(s.pairs))"""

# A backfilled hour whose computed knowledge time lies after the fetch cannot be right.
NOT_YET_KNOWN = """exists(series_values, s ->
    array_max(s.pairs.time) - s.lead * 86400 + lag_minutes * 60 > unix_seconds(fetched_at))"""

# What was forecast as text: independent of the order it came in and of when it was fetched.
CONTENT = """
array_join(
  transform(
    array_sort(filter(series_values, s -> size(s.pairs) > 0)),
    s -> concat(s.series, ' ', s.lead, ' ', array_join(
      transform(array_sort(s.pairs), p -> concat(p.time, '=', p.value)), ' '))),
  '\n')"""


def parse(responses: DataFrame) -> DataFrame:
    """Add ``entries``: one struct per point. A single object counts as a list of one; a body
    that is neither leaves ``entries`` null."""
    return responses.withColumn("entries", F.from_json("body", BODY))


def zone_values(responses: DataFrame, layouts: DataFrame, kind: str) -> DataFrame:
    """One row per response: its ``problem``, or its zone values as arrays.

    Adds ``problem`` (null when the response is as declared), ``series_values`` (per series and
    lead, the valid times and values), ``rows``, ``dropped`` (zone-hours lost to a missing
    point), ``valid_from``/``valid_to``, ``days`` and ``digest``.

    Write the result to a table before filtering it: a filter would be pushed below the
    parsing, and parse every body once more for each column it mentions.
    """
    kept = [c for c in responses.columns if c != "body"]
    wanted = responses.where(F.col("kind") == kind) if "kind" in kept else responses
    refused = f"""CASE
        WHEN problem IS NOT NULL THEN problem
        WHEN {REPEATED} THEN 'a business key repeats within one posting'"""
    if kind == PREVIOUS_RUNS:
        refused += f"""
        WHEN {NOT_YET_KNOWN} THEN 'valid hours would be posted after they were ingested'"""
    return (
        parse(wanted.join(layouts, "product", "left"))
        .selectExpr("*", f"{PROBLEM} AS problem")
        .selectExpr(
            *kept, "lag_minutes", "problem", f"{SERIES_VALUES} AS series_values",
            "CASE WHEN problem IS NULL THEN "
            "size(zones) * size(columns) * size(entries[0].hourly['time']) END AS _cells",
        )
        .selectExpr(
            *kept, "lag_minutes", "series_values", "_cells",
            f"{refused} END AS problem",
            "aggregate(series_values, 0, (n, s) -> n + size(s.pairs)) AS rows",
            "array_distinct(flatten(transform(series_values, s -> s.pairs.time))) AS _times",
        )
        .selectExpr(
            *kept, "lag_minutes", "problem",
            "CASE WHEN problem IS NULL THEN series_values END AS series_values",
            "rows", "_cells - rows AS dropped",
            "timestamp_seconds(array_min(_times)) AS valid_from",
            "timestamp_seconds(array_max(_times)) AS valid_to",
            "array_sort(array_distinct(transform(_times, t -> date(timestamp_seconds(t))))) AS days",
            f"CASE WHEN problem IS NULL THEN sha2({CONTENT}, 256) END AS digest",
        )
    )


def forecast_rows(values: DataFrame, kind: str, *extra: str) -> DataFrame:
    """The curated rows of accepted responses, with the partition columns of their table and
    any ``extra`` columns of the response.

    Refused responses have no values. The outer forms keep Spark from deriving a filter on the
    arrays and computing them twice; the rows they add are taken out again.
    """
    series = values.select(
        "product", "fetched_at", "lag_minutes", *extra, F.explode_outer("series_values").alias("s")
    )
    pairs = series.select(
        "product", "fetched_at", "lag_minutes", *extra, "s.series", "s.lead",
        F.inline_outer("s.pairs"),
    ).where("time IS NOT NULL")
    start = F.timestamp_seconds("time")
    posted = F.col("fetched_at")
    unit = F.concat(F.lit("part-"), stamp(F.col("fetched_at")))
    if kind == PREVIOUS_RUNS:
        posted = backfill_posted_at(start, F.col("lead"), F.col("lag_minutes"))
        unit = F.lit("previous-runs")
    return pairs.select(
        start.alias("interval_start"),
        F.lit(INTERVAL_MINUTES).alias("interval_minutes"),
        posted.alias("posted_at"),
        F.col("fetched_at").alias("ingested_at"),
        F.lit(kind).alias("source"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "series",
        "value",
        "product",
        F.to_date(start).alias("date"),
        unit.alias("posting"),
        *extra,
    )


def trim(responses: DataFrame, hours: int) -> DataFrame:
    """Bodies cut to their first ``hours`` hours, without the volatile timing field: what a
    committed sample is made of."""
    shape = """array<struct<latitude: double, longitude: double, elevation: double,
        hourly_units: map<string, string>, hourly: map<string, array<double>>>>"""
    short = F.transform(
        F.from_json("body", shape),
        lambda e: e.withField(
            "hourly", F.transform_values(e["hourly"], lambda _, v: F.slice(v, 1, hours))
        ),
    )
    return responses.withColumn("body", F.to_json(short))
