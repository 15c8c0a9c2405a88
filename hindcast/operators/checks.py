"""The data contract as counts per product."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.contract import (
    BUSINESS_KEY,
    FORECAST,
    LIVE,
    PREVIOUS_RUNS,
    SUPPORTED_SCHEMA_VERSIONS,
)

SAMPLE = 5


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def repeated_keys(rows: DataFrame) -> DataFrame:
    """Business keys that occur more than once within a posting.

    ``same_source`` tells a real repeat from a live and a backfilled row that tie, which the
    contract allows.
    """
    live, past = F.count_if(F.col("source") == LIVE), F.count_if(F.col("source") == PREVIOUS_RUNS)
    counted = rows.groupBy("product", *BUSINESS_KEY, "posted_at").agg(
        F.count("*").alias("n"), live.alias("_live"), past.alias("_past")
    )
    same = F.greatest("_live", "_past", F.col("n") - F.col("_live") - F.col("_past")) > 1
    return counted.where("n > 1").withColumn("same_source", same).drop("_live", "_past")


def unknown_series(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Series present but not in the catalog."""
    return rows.select("product", "series").distinct().join(
        expected.select("product", "series"), ["product", "series"], "left_anti"
    )


def live_postings(rows: DataFrame) -> DataFrame:
    """Number of distinct live postings per product."""
    distinct = rows.where(F.col("source") == LIVE).select("product", "posted_at").distinct()
    return distinct.groupBy("product").agg(F.count("posted_at").alias("n"))


def facts(rows: DataFrame, *by: str) -> DataFrame:
    """What a report is made of, as ``(product, *by, fact, value, n)``, from one scan.

    Rows are brought together once, by key and posting; all else is counted from that. Facts of parts
    of a table add up to those of the whole if no key is in two parts, as with parts by valid day.
    """
    keyed = rows.groupBy("product", *by, *BUSINESS_KEY, "posted_at").agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("source") == LIVE).alias("_live"),
        F.count_if(F.col("source") == PREVIOUS_RUNS).alias("_past"),
        F.count_if(any_null(FORECAST.fieldNames())).alias("_nulls"),
        F.count_if(F.col("posted_at") > F.col("ingested_at")).alias("_late"),
        F.collect_set(F.struct("schema_version")).alias("_versions"),
    )
    same = F.greatest("_live", "_past", F.col("_n") - F.col("_live") - F.col("_past")) > 1

    def fact(name: str, n: Column | str, value: Column | None = None) -> Column:
        text = F.lit(None) if value is None else value
        n = F.col(n) if isinstance(n, str) else n
        return F.struct(
            F.lit(name).alias("fact"), text.cast("string").alias("value"), n.cast("long").alias("n")
        )

    one = F.lit(1)
    found = F.array(
        fact("rows", "_n"),
        fact("null_in_required_column", "_nulls"),
        fact("posted_after_ingested", "_late"),
        fact("key_repeated_in_posting", F.col("_n") > 1),
        fact("key_repeated_in_posting_and_source", same),
        fact("series", one, F.col("series")),
        fact("live_posting", (F.col("_live") > 0) & F.col("posted_at").isNotNull(), F.unix_micros("posted_at")),
    )
    versions = F.transform("_versions", lambda v: fact("version", one, v["schema_version"]))
    every = keyed.select("product", *by, F.inline(F.concat(found, versions))).where("n > 0")
    return every.groupBy("product", *by, "fact", "value").agg(F.sum("n").alias("n"))


def report(found: DataFrame, expected: DataFrame) -> DataFrame:
    """``(product, check, n, sample)`` from facts and the catalog's series."""
    products = expected.select("product").distinct()
    total = found.groupBy("product", "fact", "value").agg(F.sum("n").alias("n"))
    counted = (
        total.where(F.col("fact").isin(*COUNTED))
        .groupBy("product", F.col("fact").alias("check"))
        .agg(F.sum("n").alias("n"))
    )
    several = F.when(F.col("fact") == "series", "series").when(F.col("fact") == "live_posting", "live_postings")
    distinct = total.select("product", several.alias("check")).where("check IS NOT NULL")
    distinct = distinct.groupBy("product", "check").agg(F.count("*").alias("n"))
    series = total.where("fact = 'series'").select("product", F.col("value").alias("series"))
    version = F.col("value").alias("schema_version")
    versions = total.where("fact = 'version'").select("product", version).where(
        ~F.coalesce(F.col("schema_version").isin([str(v) for v in SUPPORTED_SCHEMA_VERSIONS]), F.lit(False))
    )
    parts = [
        counted,
        distinct,
        _sampled(unknown_series(series, expected), "series", "series_not_in_catalog"),
        _sampled(versions, "schema_version", "unknown_schema_version"),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    checks = products.select("product", F.explode(F.array(*[F.lit(c) for c in CHECKS])).alias("check"))
    return checks.join(every, ["product", "check"], "full_outer").select(
        "product", "check", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "sample"
    )


def verify(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """``(product, check, n, sample)``: how often each rule is broken, zero when it holds, and
    the counts of rows, series and live postings. The rows are scanned once.
    """
    return report(facts(rows), expected)


RULES = (
    "null_in_required_column",
    "key_repeated_in_posting",
    "key_repeated_in_posting_and_source",
    "series_not_in_catalog",
    "unknown_schema_version",
    "posted_after_ingested",
)
COUNTED = ("rows", *(r for r in RULES if r not in ("series_not_in_catalog", "unknown_schema_version")))
CHECKS = ("rows", "series", "live_postings", *RULES)


def _sampled(distinct: DataFrame, column: str, check: str) -> DataFrame:
    """How many distinct offenders, and the first few by name. The rest are only counted."""
    first = Window.partitionBy("product").orderBy(column)
    ranked = distinct.withColumn("_rank", F.row_number().over(first)).where(f"_rank <= {SAMPLE}")
    sample = ranked.groupBy("product").agg(
        F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), ", ").alias(
            "sample"
        )
    )
    counts = distinct.groupBy("product").agg(F.count("*").alias("n"))
    return counts.join(sample, "product", "left").select(
        "product", F.lit(check).alias("check"), "n", "sample"
    )
