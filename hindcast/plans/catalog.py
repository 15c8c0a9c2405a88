"""The catalog: what a lake holds, as one small JSON document and as tables."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.contract import (
    BUSINESS_KEY,
    CONTRACT_VERSION,
    INTERVAL_MINUTES,
    SCHEMA_VERSION,
    SUPPORTED_SCHEMA_VERSIONS,
    readable_contract,
)
from hindcast.errors import (
    BusyError,
    CatalogNotFoundError,
    IncompatibleContractError,
    UnknownProductError,
    UnsupportedSchemaVersionError,
)
from hindcast.functions.columns import series_name
from hindcast.settings import Product, frame
from hindcast.sources import storage

ENTRY_FIELDS = """
    name: string, source: string, model: string, interval_minutes: int, schema_version: int,
    variables: map<string, string>,
    zones: map<string, array<struct<name: string, lat: double, lon: double>>>,
    live: boolean"""


@dataclass(frozen=True)
class Catalog:
    """A parsed catalog document; fields it does not know are ignored."""

    contract_version: str
    generated_at: str
    products: Mapping[str, Mapping]

    def entry(self, product: str) -> Mapping:
        """A product's entry, if it is listed and at a schema version this package reads."""
        found = self.products.get(product)
        if found is None:
            raise UnknownProductError(f"{product} is not in the catalog, which lists {[*self.products]}")
        if found["schema_version"] in SUPPORTED_SCHEMA_VERSIONS:
            return found
        raise UnsupportedSchemaVersionError(
            f"{product} has rows of schema {found['schema_version']}; "
            f"readable are {SUPPORTED_SCHEMA_VERSIONS}"
        )


def catalog_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifests/_catalog.json"


def parse_catalog(text: str) -> Catalog:
    doc = json.loads(text)
    catalog = Catalog(doc["contract_version"], doc["generated_at"], doc["products"])
    if not readable_contract(catalog.contract_version):
        raise IncompatibleContractError(
            f"the lake follows contract {catalog.contract_version}, this package {CONTRACT_VERSION}"
        )
    return catalog


def load_catalog(spark: SparkSession, root: str) -> Catalog:
    """Read the document itself: Spark's file sources skip names starting with ``_``."""
    uri = catalog_path(root)
    if not storage.exists(spark, uri):
        raise CatalogNotFoundError(f"no catalog at {uri}")
    return parse_catalog(storage.read_text(spark, uri))


# -- as tables -----------------------------------------------------------------------------


def entries(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """One row per product, as the document lists them."""
    rows = [{"product": key, **entry} for key, entry in catalog.products.items()]
    return frame(spark, rows, f"array<struct<product: string, {ENTRY_FIELDS}>>")


def declared_entries(spark: SparkSession, products: Sequence[Product]) -> DataFrame:
    """One row per configured product."""
    rows = [
        {
            "product": p.key,
            "name": p.name,
            "source": p.source,
            "model": p.model,
            "interval_minutes": INTERVAL_MINUTES,
            "schema_version": SCHEMA_VERSION,
            "variables": dict(p.variables),
            "zones": {
                zone: [{"name": q.name, "lat": q.lat, "lon": q.lon} for q in points]
                for zone, points in p.zones.items()
            },
            "live": True,
        }
        for p in products
    ]
    return frame(spark, rows, f"array<struct<product: string, {ENTRY_FIELDS}>>")


def variables(products: DataFrame) -> DataFrame:
    return products.select("product", F.explode("variables").alias("variable", "unit"))


def zone_points(products: DataFrame) -> DataFrame:
    """Every point with its position within its zone."""
    zones = products.select("product", F.explode("zones").alias("zone", "points"))
    return zones.select("product", "zone", F.posexplode("points").alias("pos", "point")).select(
        "product", "zone", "pos", "point.*"
    )


def expected_series(products: DataFrame) -> DataFrame:
    """Every series a product may hold: each variable with each zone."""
    pairs = products.select(
        "product", "zones", F.explode(F.map_keys("variables")).alias("variable")
    ).select("product", "variable", F.explode(F.map_keys("zones")).alias("zone"))
    return pairs.select("product", series_name(F.col("variable"), F.col("zone")).alias("series"))


def merge_entries(old: DataFrame, new: DataFrame) -> DataFrame:
    """The next catalog: configured products as configured, vanished ones kept but not live.

    ``changed`` says whether a product's entry differs from the old one.
    """
    columns = [c for c in new.columns if c != "product"]
    o = old.select("product", F.struct(*columns).alias("o"))
    n = new.select("product", F.struct(*columns).alias("n"))
    retired = F.col("o").withField("live", F.lit(False))
    return (
        o.join(n, "product", "full_outer")
        .withColumn("e", F.coalesce(F.col("n"), retired))
        .select(
            "product",
            "e.*",
            (~F.col("e").isNotNull() | ~_canonical("o").eqNullSafe(_canonical("e"))).alias(
                "changed"
            ),
        )
    )


def _canonical(entry: str):
    """An entry as text that does not depend on the order of its maps."""
    ordered = F.col(entry)
    for name in ("variables", "zones"):
        ordered = ordered.withField(name, F.array_sort(F.map_entries(F.col(f"{entry}.{name}"))))
    return F.when(F.col(entry).isNotNull(), F.to_json(ordered))


def publish_catalog(
    spark: SparkSession, root: str, products: Sequence[Product], now: datetime, *, tries: int = 20
) -> bool:
    """Write the catalog if anything but its timestamp changed; True when written.

    Readers get the old document or the new one. Of several publishers at a time each merges its
    products into what the others have written: one that comes second looks and merges again, up to
    ``tries`` times.
    """
    uri = catalog_path(root)
    new = declared_entries(spark, products)
    for attempt in range(tries):
        seen = storage.read_text(spark, uri) if storage.exists(spark, uri) else None
        text = _next_catalog(spark, seen, new, now)
        if text is None:
            return False
        if storage.publish(spark, uri, seen, text):
            return True
        time.sleep(min(0.05 * 2**attempt, 5.0))
    raise BusyError(f"{uri} is being written by others")


def _next_catalog(spark: SparkSession, seen: str | None, new: DataFrame, now: datetime) -> str | None:
    """The document after the one seen; None if it would say the same."""
    old, missing = new.limit(0), seen is None
    if seen is not None:
        doc = json.loads(seen)
        old = entries(spark, Catalog(doc["contract_version"], doc["generated_at"], doc["products"]))
        missing = doc["contract_version"] != CONTRACT_VERSION
    merged = merge_entries(old, new).orderBy("product").toJSON().collect()
    rows = [json.loads(row) for row in merged]
    if not missing and not any(row["changed"] for row in rows):
        return None
    doc = {
        "contract_version": CONTRACT_VERSION,
        "generated_at": now.isoformat(),
        "business_key": list(BUSINESS_KEY),
        "products": {
            row["product"]: {k: v for k, v in row.items() if k not in ("product", "changed")}
            for row in rows
        },
    }
    return json.dumps(doc, indent=2, ensure_ascii=False) + "\n"
