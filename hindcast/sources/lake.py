"""Where a lake's tables live and how they are scanned and written.

``curated/product=<p>/date=<valid day>/posting=<unit>/`` is this package's own layout: the
``posting`` folder is the unit a rerun replaces. A lake laid out as one file per posting
(``curated/<p>/date=<valid day>/part-<stamp>.parquet``) is read as well.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.contract import FORECAST, LIVE, PREVIOUS_RUNS, PRODUCT_PATTERN
from hindcast.functions.columns import instant, parse_stamp, stamp
from hindcast.session import configure
from hindcast.settings import frame
from hindcast.sources import storage
from hindcast.sources.raw import FORMAT, NamedFiles

CURATED_TABLE = T.StructType(
    [
        *FORECAST.fields,
        T.StructField("product", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("posting", T.StringType()),
    ]
)
LANDED = (
    "product string, kind string, fetched_at timestamp, first date, last date, body string, "
    "date date, batch string"
)
POLLS = (
    "product string, fetched_at timestamp, new_posting boolean, digest string, rows long, "
    "dropped long, valid_from timestamp, valid_to timestamp, partitions array<date>, "
    "raw_key string, date date, batch string"
)
WINDOWS = (
    "product string, first date, last date, fetched_at timestamp, rows long, dropped long, "
    "days array<date>, batch string"
)
QUARANTINE = (
    "product string, kind string, fetched_at timestamp, raw_key string, problem string, "
    "batch string"
)
DAY_FACTS = "files long, fact string, value string, n long, product string, date date"
MANIFEST = (
    "product string, model string, schema_version int, last_posted_at timestamp, "
    "last_checked_at timestamp, valid_from timestamp, valid_to timestamp, "
    "content_hash string, rows long, dropped long, partitions array<string>, raw_key string"
)


class Lake:
    """The tables below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = str(root).rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # -- curated ---------------------------------------------------------------------------

    def curated_products(self) -> list[str]:
        names = storage.children(self.spark, self.path("curated"))
        return sorted({n.removeprefix("product=") for n in names if not n.startswith(("_", "."))})

    def curated(
        self,
        products: Sequence[str] | None = None,
        first: date | None = None,
        last: date | None = None,
    ) -> DataFrame:
        """Every curated row of the products, read by name: a missing column comes back null.

        With a day range only those days' folders are listed, so a read costs nothing for the
        rest of the product's history. The scan is lazy: a filter on ``interval_start`` or
        ``posted_at`` still skips row groups.

        Units that a compaction has written but not yet put in place, and those it has replaced but
        not yet deleted, are left out: every row is read once at any moment of it. If that changed
        while files were listed, they are listed again.
        """
        while True:
            records = self._compactions()
            rows = self._listed(products, first, last)
            if records == self._compactions():
                break
        hidden = self.hidden_units([name for name, length, _ in records if length])
        if not hidden:
            return rows
        units = frame(self.spark, hidden, "array<struct<product: string, date: date, posting: string>>")
        return rows.join(units, ["product", "date", "posting"], "left_anti").select(*rows.columns)

    def _compactions(self) -> list[tuple[str, int, int]]:
        return storage.states(self.spark, self.path("compactions"))

    def hidden_units(self, records: Sequence[str]) -> list[dict]:
        """The units that records of compactions name."""
        lines = [
            line
            for name in records
            for line in storage.read_text(self.spark, self.path("compactions", name)).splitlines()
        ]
        found = [json.loads(line) for line in lines]
        return [u | {"date": date.fromisoformat(u["date"])} for u in found]

    def _listed(
        self, products: Sequence[str] | None, first: date | None, last: date | None
    ) -> DataFrame:
        wanted = self.curated_products() if products is None else list(products)
        base = self.path("curated")
        there = set(storage.children(self.spark, base))
        parts = []
        own = [p for p in wanted if f"product={p}" in there]
        if own and first is None:
            parts.append(self.own_curated(own))
        elif own:
            folders = [f"{base}/product={p}" for p in own]
            days = [d for folder in folders for d in self._day_folders(folder, first, last)]
            if days:
                parts.append(self._own(days))
        for product in wanted:
            folder = f"{base}/{product}"
            if product in there:
                days = [folder] if first is None else self._day_folders(folder, first, last)
                if days:
                    parts.append(self._flat_curated(product, folder, days))
        if not parts:
            return empty(self.spark, CURATED_TABLE)
        return reduce(DataFrame.unionByName, parts)

    def own_curated(self, products: Sequence[str]) -> DataFrame:
        """The same for products in this package's own layout, as one plain scan."""
        return self._own([self.path("curated", f"product={p}") for p in products])

    def own_days(self, folders: Sequence[str]) -> DataFrame:
        """The rows of some day folders of the own layout."""
        return self._own(folders) if folders else empty(self.spark, CURATED_TABLE)

    def _own(self, folders: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(CURATED_TABLE).option("basePath", self.path("curated"))
        return reader.parquet(*folders)

    def _day_folders(self, folder: str, first: date, last: date) -> list[str]:
        lower, upper = f"date={first}", f"date={last}"
        names = storage.children(self.spark, folder)
        return [f"{folder}/{name}" for name in names if lower <= name <= upper]

    def _flat_curated(self, product: str, folder: str, days: Sequence[str]) -> DataFrame:
        schema = T.StructType([*FORECAST.fields, T.StructField("date", T.DateType())])
        name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
        reader = self.spark.read.schema(schema).option("basePath", folder)
        return reader.parquet(*days).select(
            *FORECAST.fieldNames(),
            F.lit(product).alias("product"),
            "date",
            F.regexp_replace(name, r"\.parquet$", "").alias("posting"),
        )

    def write_postings(self, rows: DataFrame) -> None:
        """Replace exactly the (product, date, posting) folders the rows fall into."""
        (
            rows.select(*CURATED_TABLE.fieldNames())
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("product", "date", "posting")
            .parquet(self.path("curated"))
        )

    def write_flat(self, rows: DataFrame) -> None:
        """Write one file per product, day and posting, ``curated/<p>/date=<d>/<posting>.parquet``, in
        place of any of that name. Files are written aside by the tasks and then renamed."""
        unit = ("product", "date", "posting")
        order = ("interval_start", "series", "posted_at", "ingested_at")
        aside = self.path("_aside", uuid.uuid4().hex)
        (
            rows.select(*CURATED_TABLE.fieldNames())
            .repartition(*unit)
            .sortWithinPartitions(*unit, *order)
            .write.option("compression", "zstd")
            .partitionBy(*unit)
            .parquet(aside)
        )
        pattern = re.compile(r"/product=([^/]+)/date=([^/]+)/posting=([^/]+)/[^/]+$")
        files = {f: pattern.search(f).groups() for f in storage.files_below(self.spark, aside)}
        if len(set(files.values())) < len(files):
            raise RuntimeError("a posting came out as several files")
        moves = [(f, self.path("curated", p, f"date={d}", f"{u}.parquet")) for f, (p, d, u) in files.items()]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda names: storage.move(self.spark, *names), moves))
        storage.delete_below(self.spark, aside, guard=self.path("_aside"))

    def flat_days(self, folders: Sequence[str]) -> DataFrame:
        """The rows of some day folders of the flat layout, in one scan."""
        if not folders:
            return empty(self.spark, CURATED_TABLE)
        reader = self.spark.read.schema(FORECAST).option("recursiveFileLookup", "true")
        path = F.col("_metadata.file_path")
        pattern = r"/([^/]+)/date=(\d{4}-\d{2}-\d{2})/([^/]+)\.parquet$"
        return reader.option("pathGlobFilter", "*.parquet").parquet(*folders).select(
            *FORECAST.fieldNames(),
            F.regexp_extract(path, pattern, 1).alias("product"),
            F.to_date(F.regexp_extract(path, pattern, 2)).alias("date"),
            F.regexp_extract(path, pattern, 3).alias("posting"),
            F.col("_metadata.row_index").alias("_row"),
        )

    def day_folders(self, flat: bool = False) -> list[tuple[str, str, str]]:
        """``(day, product, folder)`` of this package's own layout, or of the flat one, the oldest day
        first. Only names of folders are listed."""
        base, found = self.path("curated"), []
        for name in storage.children(self.spark, base):
            if name.startswith("product=") != flat and not name.startswith(("_", ".")):
                days = storage.children(self.spark, f"{base}/{name}")
                product = name.removeprefix("product=")
                found += [
                    (day.removeprefix("date="), product, f"{base}/{name}/{day}")
                    for day in days
                    if day.startswith("date=")
                ]
        return sorted(found)

    def product_folders(self, product: str) -> list[str]:
        """Where a product's files are, in either layout."""
        names = storage.children(self.spark, self.path("curated"))
        own = [n for n in (f"product={product}", product) if n in names]
        return [self.path("curated", n) for n in own]

    def curated_files(self, folders: Sequence[str] | None = None) -> DataFrame:
        """One row per data file, from the listing alone; ``own`` marks this package's layout.
        With folders only those are listed."""
        base = self.path("curated")
        pattern = r"/(product=)?([^/]+)/date=(\d{4}-\d{2}-\d{2})/(posting=([^/]+)/)?([^/]+)\.parquet$"
        shape = (
            "path string, product string, date date, posting string, own boolean, "
            "modified_at timestamp, length long"
        )
        if not self.curated_products():
            return empty(self.spark, T.StructType.fromDDL(shape))
        listing = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(base if folders is None else list(folders))
        )
        path = F.col("path")
        own = F.regexp_extract(path, pattern, 4) != ""
        return listing.where(path.rlike(pattern)).select(
            "path",
            F.regexp_extract(path, pattern, 2).alias("product"),
            F.to_date(F.regexp_extract(path, pattern, 3)).alias("date"),
            F.when(own, F.regexp_extract(path, pattern, 5))
            .otherwise(F.regexp_extract(path, pattern, 6))
            .alias("posting"),
            own.alias("own"),
            F.col("modificationTime").alias("modified_at"),
            "length",
        )

    def visible_files(self) -> DataFrame:
        """:meth:`curated_files` without those of units that a compaction hides."""
        hidden = self.hidden_units([name for name, length, _ in self._compactions() if length])
        files = self.curated_files()
        if not hidden:
            return files
        shape = "array<struct<product: string, date: date, posting: string>>"
        return files.join(frame(self.spark, hidden, shape), ["product", "date", "posting"], "left_anti")

    def day_facts(self) -> DataFrame:
        """What :func:`hindcast.plans.verify.verify_lake` remembers of each day."""
        return self._table("day_facts", DAY_FACTS)

    def keep_day_facts(self, facts: DataFrame) -> None:
        """Replace the facts of the days these rows are of."""
        (
            facts.repartition("product", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("product", "date")
            .parquet(self.path("day_facts"))
        )

    # -- raw -------------------------------------------------------------------------------

    def raw_files(self, days: Sequence[date] | None = None) -> DataFrame:
        """Responses kept as files, one row per body, with what their names say about them.

        With ``days`` only the folders of those days of fetching are listed.
        """
        parts = []
        for product in storage.children(self.spark, self.path("raw")):
            if product.startswith(("_", ".")):
                continue
            folder = self.path("raw", product)
            folders = [folder]
            if days is not None:
                there = set(storage.children(self.spark, folder))
                folders = [f"{folder}/date={d}" for d in days if f"date={d}" in there]
            if folders:
                reader = self.spark.read.schema("value string, date date")
                parts.append(reader.option("basePath", folder).text(folders, wholetext=True))
        if not parts:
            shape = T.StructType.fromDDL("body string, raw_key string, date date")
            return name_parts(empty(self.spark, shape))
        files = [
            part.select(
                F.col("value").alias("body"), F.col("_metadata.file_path").alias("raw_key"), "date"
            )
            for part in parts
        ]
        return name_parts(reduce(DataFrame.unionByName, files))

    def keep_raw(self, responses: DataFrame) -> None:
        """Write each body as a file under the name :func:`raw_name` gives it. Written by the tasks;
        a file of that name that is there already stays as it is."""
        self.spark.dataSource.register(NamedFiles)
        files = responses.select(raw_name().alias("name"), "body").where("body IS NOT NULL")
        files.write.format(FORMAT).option("root", self.root).mode("append").save()

    def land_responses(self, responses: DataFrame, batch: str) -> None:
        """Keep bodies before anything parses them. Nothing landed is ever replaced: landing a
        batch again adds only what is not there yet.

        Nothing is shuffled for a new batch: it should come in as many tasks as it is worth files
        a day.
        """
        rows = responses.select(
            "product", "kind", "fetched_at", "first", "last", "body",
            F.to_date("fetched_at").alias("date"), F.lit(batch).alias("batch"),
        )
        there = self._table("responses", LANDED).where(F.col("batch") == batch)
        if not there.isEmpty():
            same = [rows[c].eqNullSafe(there[c]) for c in ("product", "kind", "fetched_at", "body")]
            rows = rows.join(there, reduce(Column.__and__, same), "left_anti")
        parts = ("kind", "date", "batch")
        rows.write.mode("append").partitionBy(*parts).parquet(self.path("responses"))

    def kept_responses(self, days: Sequence[date]) -> DataFrame:
        """Bodies fetched on some days, landed or kept as files."""
        return self.responses(days).unionByName(self.raw_files(days))

    def responses(self, days: Sequence[date] | None = None) -> DataFrame:
        """Landed bodies, in the shape of :meth:`raw_files`."""
        landed = with_raw_key(self._table("responses", LANDED))
        return landed if days is None else landed.where(F.col("date").isin(list(days)))

    # -- logs ------------------------------------------------------------------------------

    def polls(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Polls logged, of some days of fetching only if these are given."""
        found = self._table("polls", POLLS)
        if first is not None:
            found = found.where(F.col("date") >= F.lit(first))
        return found if last is None else found.where(F.col("date") <= F.lit(last))

    def has_polls_before(self, day: date) -> bool:
        """From the names of the log's folders."""
        names = storage.children(self.spark, self.path("polls"))
        return any(name.startswith("date=") and name < f"date={day}" for name in names)

    def windows(self) -> DataFrame:
        return self._table("windows", WINDOWS)

    def quarantine(self) -> DataFrame:
        return self._table("quarantine", QUARANTINE)

    def log_polls(self, polls: DataFrame, batch: str) -> None:
        self._append(polls.withColumn("date", F.to_date("fetched_at")), "polls", batch, "date")

    def log_windows(self, windows: DataFrame, batch: str) -> None:
        self._append(windows, "windows", batch, "product")

    def log_quarantine(self, rows: DataFrame, batch: str) -> None:
        """A batch repeated without bad responses leaves none of its earlier ones behind."""
        if rows.isEmpty():
            folder = self.path("quarantine", f"batch={batch}")
            storage.delete_below(self.spark, folder, guard=self.path("quarantine"))
        else:
            self._append(rows, "quarantine", batch)

    def manifests(self) -> DataFrame:
        """``manifests/<product>/latest.json`` of a lake that keeps them as files."""
        base = self.path("manifests")
        files = [f"{base}/{name}/latest.json" for name in storage.children(self.spark, base)]
        files = [file for file in files if storage.exists(self.spark, file)]
        if not files:
            return empty(self.spark, T.StructType.fromDDL(MANIFEST))
        return self.spark.read.schema(MANIFEST).json(files, multiLine=True)

    def _append(self, rows: DataFrame, table: str, batch: str, *partitions: str) -> None:
        (
            rows.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions, "batch")
            .parquet(self.path(table))
        )

    def _table(self, table: str, schema: str) -> DataFrame:
        folder = self.path(table)
        if not storage.exists(self.spark, folder):
            return empty(self.spark, T.StructType.fromDDL(schema))
        return self.spark.read.schema(schema).parquet(folder)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, in a form the optimizer sees through."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_raw_key(landed: DataFrame) -> DataFrame:
    """Name each landed response, so that logs can point at it."""
    key = F.concat_ws("/", F.lit("responses"), "product", "kind", stamp(F.col("fetched_at")))
    return landed.withColumn("raw_key", key).drop("batch")


def raw_name() -> Column:
    """The path of a response below the lake's root, from ``product``, ``kind``, ``fetched_at`` and, of
    previous runs, ``first`` and ``last``. :func:`name_parts` takes it apart again."""
    fetched = stamp(F.col("fetched_at"))
    live = F.concat(F.lit("fetched="), fetched)
    past = F.concat(F.lit("previous-runs-"), "first", F.lit("_"), "last", F.lit("-"), fetched)
    name = F.when(F.col("kind") == LIVE, live).otherwise(past)
    day = F.concat(F.lit("date="), F.to_date("fetched_at").cast("string"))
    product = F.when(F.col("product").rlike(f"^{PRODUCT_PATTERN}$"), F.col("product")).otherwise(
        F.raise_error(F.concat(F.lit("not a product key: "), F.col("product")))
    )
    return F.concat_ws("/", F.lit("raw"), product, day, F.concat(name, F.lit(".json.gz")))


def name_parts(files: DataFrame) -> DataFrame:
    """Split the names responses are kept under into product, kind, fetch time and days."""
    key = F.col("raw_key")
    live = r"/raw/([^/]+)/date=[^/]+/fetched=(\d{8}T\d{6}Z)\.json(\.gz)?$"
    past = (
        r"/raw/([^/]+)/date=[^/]+/previous-runs-(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})"
        r"-(\d{8}T\d{6}Z)\.json(\.gz)?$"
    )
    is_live = key.rlike(live)

    def part(live_group: int, past_group: int) -> Column:
        return F.when(is_live, F.regexp_extract(key, live, live_group)).otherwise(
            F.regexp_extract(key, past, past_group)
        )

    fetched = parse_stamp(part(2, 4))
    return files.where(is_live | key.rlike(past)).select(
        part(1, 1).alias("product"),
        F.when(is_live, LIVE).otherwise(PREVIOUS_RUNS).alias("kind"),
        fetched.alias("fetched_at"),
        F.when(~is_live, F.to_date(F.regexp_extract(key, past, 2))).alias("first"),
        F.when(~is_live, F.to_date(F.regexp_extract(key, past, 3))).alias("last"),
        "raw_key",
        "body",
        F.col("date") if "date" in files.columns else F.to_date(fetched).alias("date"),
    )


def older_than(files: DataFrame, now, minutes: int) -> DataFrame:
    """Files nobody can still be writing: last modified at least ``minutes`` before ``now``."""
    return files.where(
        F.col("modified_at") <= instant(now) - F.make_dt_interval(mins=F.lit(minutes))
    )
