"""Whether Parquet files have the contract's columns, asked of Spark's own readers."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.contract import FORECAST

#: What Spark raises for files it cannot read or schemas it cannot merge.
UNREADABLE = (PySparkException, Py4JJavaError)


def merged_columns(spark: SparkSession, folders: Sequence[str]) -> T.StructType | None:
    """All columns of all files below the folders; none if two files disagree on a type or one is
    not Parquet. Spark reads the footers in parallel and merges them on the executors."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    try:
        return reader.option("pathGlobFilter", "*.parquet").parquet(*folders).schema
    except UNREADABLE:
        return None


def on_contract(columns: T.StructType | None) -> bool:
    """Exactly the contract's columns and types, in any order."""
    if columns is None:
        return False
    kinds = {f.name: f.dataType for f in columns.fields}
    return kinds == {f.name: f.dataType for f in FORECAST.fields}


def off_contract(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """The folders with a file of other columns or types. Halves are looked at until single folders
    remain, so folders as they should be cost one look together.

    A column that only some files lack is not seen here: it reads as null, which the rows show.
    """
    if not folders:
        return []
    if on_contract(merged_columns(spark, folders)):
        return _narrower(spark, folders)
    if len(folders) == 1:
        return list(folders)
    half = len(folders) // 2
    return off_contract(spark, folders[:half]) + off_contract(spark, folders[half:])


def _narrower(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """Folders with files whose values are single precision, which merging widens without a word.

    Files in double precision cannot be read as that and are passed over at their first page.
    """
    reader = spark.read.schema("value float").option("ignoreCorruptFiles", "true")
    files = reader.option("recursiveFileLookup", "true").parquet(*folders)
    rows = files.select(F.col("_metadata.file_path").alias("path"), "value")
    paths = rows.groupBy("path").agg(F.max("value")).collect()
    ends = {"/" + "/".join(folder.split("/")[-2:]) + "/": folder for folder in folders}
    return sorted({f for end, f in ends.items() if any(end in r["path"] for r in paths)})


def missing_columns(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """The contract's columns that no readable file below the folders has."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    reader = reader.option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet")
    try:
        there = set(reader.parquet(*folders).schema.fieldNames())
    except UNREADABLE:  # types that cannot be merged, or nothing readable
        there = set()
        for folder in folders:
            try:
                there |= set(spark.read.option("recursiveFileLookup", "true").parquet(folder).columns)
            except UNREADABLE:
                continue
    return sorted(set(FORECAST.fieldNames()) - there)
