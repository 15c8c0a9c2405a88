"""Check a whole lake against its contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.operators import checks
from hindcast.plans.catalog import entries, expected_series, load_catalog
from hindcast.session import Scratch, shared_folder
from hindcast.settings import frame
from hindcast.sources.conformance import missing_columns
from hindcast.sources.lake import Lake


def verify_lake(lake: Lake, *, remember: bool = False) -> DataFrame:
    """``(product, check, n, sample)`` for every product of the catalog.

    With ``remember`` the facts of each valid day are kept with the lake, and only days whose files
    have changed since the last such run are scanned; the report is the same.

    A product without files, or whose files lack a column altogether, gets that one finding
    and is not looked at further.
    """
    products = entries(lake.spark, load_catalog(lake.spark, lake.root))
    state = []  # one row per catalogued product
    for product in [r["product"] for r in products.select("product").collect()]:
        folders = lake.product_folders(product)
        filled = bool(folders) and not lake.curated_files(folders).limit(1).isEmpty()
        missing = missing_columns(lake.spark, folders) if filled else []
        state.append({"product": product, "empty": int(not filled), "missing": missing})
    sound = [s["product"] for s in state if not s["empty"] and not s["missing"]]
    shape = "array<struct<product: string, empty: bigint, missing: array<string>>>"
    listed = frame(lake.spark, state, shape).select(
        "product",
        F.inline(
            F.array(
                F.struct(
                    F.lit("no_curated_files").alias("check"),
                    F.col("empty").alias("n"),
                    F.lit(None).cast("string").alias("sample"),
                ),
                F.struct(
                    F.lit("missing_columns").alias("check"),
                    F.size("missing").cast("long").alias("n"),
                    F.when(F.col("empty") == 0, F.array_join("missing", ", ")).alias("sample"),
                ),
            )
        ),
    )
    expected = expected_series(products.where(F.col("product").isin(sound)))
    if remember:
        return listed.unionByName(checks.report(_remembered(lake, sound), expected))
    return listed.unionByName(checks.verify(lake.curated(sound), expected))


def _remembered(lake: Lake, products: Sequence[str]) -> DataFrame:
    """The facts of all days of some products, those of changed days counted anew.

    A day's files are told by a hash over their names, sizes and times of change. Days without files
    drop out; a day that changes while it is scanned is scanned again next time, since the files were
    listed before.
    """
    files = lake.visible_files().where(F.col("product").isin(list(products)))
    each = F.xxhash64("path", "length", "modified_at")
    days = files.groupBy("product", "date").agg(
        F.xxhash64(F.array_sort(F.collect_list(each))).alias("files")
    )
    with Scratch(lake.spark, "verify") as scratch:
        days = scratch.keep(days)
        known = lake.day_facts()
        changed = days.join(known, ["product", "date", "files"], "left_anti")
        if not changed.isEmpty():
            rows = lake.curated(products).join(changed, ["product", "date"])
            rows = checks.facts(rows.drop("posting"), "date", "files")
            lake.keep_day_facts(rows)
        found = lake.day_facts().join(days, ["product", "date", "files"], "left_semi")
        return _frozen(found.groupBy("product", "fact", "value").agg(F.sum("n").alias("n")), scratch)


def _frozen(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Facts of all days together, in a table of their own that outlives the scratch tables."""
    path = shared_folder(scratch.spark, "facts")
    found.write.parquet(path)
    return scratch.spark.read.schema(found.schema).parquet(path)


def problems(report: DataFrame) -> DataFrame:
    """The broken rules of a report. A tie between a live and a backfilled row is not one."""
    rules = [r for r in checks.RULES if r != "key_repeated_in_posting"]
    broken = F.col("check").isin(["no_curated_files", "missing_columns", *rules])
    return report.where(broken & (F.col("n") > 0))
