"""What the operators of this folder share: words, scratch tables, digests of inputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.session import Scratch as _Scratch
from hindcast.session import shared_folder
from hindcast.sources import storage

#: Words are runs of anything but ASCII white space. ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII capitals to small letters, nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back.

    Used where a result is read more than once, or must not change when a lost executor's tasks
    run again. The files stay until the owner of ``spark.checkpoint.dir`` clears that folder.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, purpose)
    with shuffles_freed(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes a query's shuffle files as it ends, not when the driver happens to collect
    its garbage. Only for results that are written: running the same plan again would repeat it."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


class Scratch(_Scratch):
    """Scratch tables of one job, gone when it ends, or earlier if dropped."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        super().__init__(spark, purpose)
        self._paths: dict[int, str] = {}

    def keep(self, rows: DataFrame) -> DataFrame:
        with shuffles_freed(self.spark):
            table = super().keep(rows)
        self._paths[id(table)] = f"{self.folder}/{self._tables}"
        return table

    def drop(self, table: DataFrame) -> None:
        """Free the space of a table that nothing reads any more."""
        storage.delete_below(self.spark, self._paths.pop(id(table)), guard=self.folder)


def column_or_null(rows: DataFrame, name: str, kind: str) -> Column:
    """A column by name, or nulls where the table lacks it."""
    return (rows[name] if name in rows.columns else F.lit(None)).cast(kind).alias(name)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as bytes; null counts as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that what is derived from one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def training_side(doc_id: Column, modulus: int, left_out: int) -> Column:
    """True for documents to learn from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus != left_out
