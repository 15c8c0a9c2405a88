"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from hindcast.sources import storage


def configure(spark: SparkSession) -> SparkSession:
    """Days, stamps and partitions are all UTC, and timestamps are written as microseconds:
    the legacy 96-bit form carries no statistics, so no read could skip row groups."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is only made up for a local session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="hindcast-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/hindcast-{purpose}-{uuid.uuid4().hex}"


class Scratch:
    """Tables a job computes once and reads several times.

    They are written, not cached: a lost executor must not mean doing the work again, and a
    decision based on a listing must not change because the job has written files since. The
    folder is removed when the job ends.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, purpose)
        self._tables = 0

    def keep(self, rows: DataFrame) -> DataFrame:
        self._tables += 1
        table = f"{self.folder}/{self._tables}"
        rows.write.parquet(table)
        return self.spark.read.schema(rows.schema).parquet(table)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(
        self,
        kind: type[BaseException] | None,
        error: BaseException | None,
        trace: TracebackType | None,
    ) -> None:
        storage.delete_below(self.spark, self.folder, guard=self.folder.rpartition("/")[0])
