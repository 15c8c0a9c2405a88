"""The curated table: its columns, its business key and the versions this package reads."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Fixed values of the lake contract.
CONTRACT_VERSION = "1.0.0"
SCHEMA_VERSION = 1
SUPPORTED_SCHEMA_VERSIONS = (1,)
INTERVAL_MINUTES = 60
LIVE = "live"
PREVIOUS_RUNS = "previous_runs"
BUSINESS_KEY = ("interval_start", "series")
SNAPSHOT_COLUMNS = ("interval_start", "interval_minutes", "series", "value", "posted_at")
POSTINGS_COLUMNS = (*SNAPSHOT_COLUMNS, "ingested_at", "source")
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
MAX_SNAP_DEGREES = 0.25

FORECAST = T.StructType(
    [
        T.StructField("interval_start", T.TimestampType(), False),
        T.StructField("interval_minutes", T.IntegerType(), False),
        T.StructField("posted_at", T.TimestampType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("schema_version", T.IntegerType(), False),
        T.StructField("series", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
    ]
)

PRODUCT_PATTERN = r"[a-z0-9]+(-[a-z0-9]+)*"


def checked_product(product: str) -> str:
    """Product keys become path segments, so only lower-case hyphenated words are let through."""
    if not re.fullmatch(PRODUCT_PATTERN, product):
        raise ValueError(f"product keys are lower-case words joined by hyphens, not {product!r}")
    return product


def readable_contract(version: str, ours: str = CONTRACT_VERSION) -> bool:
    """Whether lakes of a contract version can be read: semantic versioning promises that releases
    up to the next breaking number, the first one that is not zero, only add."""
    here, there = ([int(n) for n in v.split(".")] for v in (ours, version))
    breaking = next((i for i, n in enumerate(here) if n), 0)
    upto = min(breaking, 1) + 1  # a patch number never breaks
    return here[:upto] == there[:upto]
