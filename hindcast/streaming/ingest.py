"""Incremental ingest: new responses become postings, each batch exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hindcast.contract import LIVE, PREVIOUS_RUNS
from hindcast.plans.curate import curate_live, curate_previous_runs
from hindcast.plans.report import raise_if_quarantined
from hindcast.settings import Product
from hindcast.sources import storage
from hindcast.sources.lake import LANDED, Lake, name_parts, with_raw_key

FILE_NAMES = {LIVE: "fetched=*.json*", PREVIOUS_RUNS: "previous-runs-*.json*"}


def ingest_stream(
    lake: Lake,
    products: Sequence[Product],
    checkpoint: str,
    *,
    kind: str = LIVE,
    unit: str = "posting",
    landed: bool = False,
    max_files_per_batch: int = 10_000,
    ran: list[str] | None = None,
) -> StreamingQuery:
    """Work through the responses of one kind that have arrived since the last run, then stop.

    They are read from the raw files, or with ``landed`` from the table of landed responses.
    A batch writes under its own id and replaces what an earlier attempt at it wrote, so a
    replay after a failure changes nothing. The id names the stream, by a mark kept with its
    checkpoint, so several streams may feed a lake and a lost checkpoint starts a new one.
    Responses that are not as declared go to the quarantine and do not hold up the rest;
    :func:`ingest` says so in the end. Polls may arrive in any order. The names of the batches that
    this run works on, replays included, are added to ``ran``.
    """
    stream = _stream_name(lake, checkpoint, kind)
    reader = lake.spark.readStream.option("maxFilesPerTrigger", max_files_per_batch)
    if landed:
        arrived = reader.schema(LANDED).parquet(lake.path("responses"))
        arrived = arrived.where(F.col("kind") == kind)
    else:
        arrived = (
            reader.option("recursiveFileLookup", True)
            .option("pathGlobFilter", FILE_NAMES[kind])
            .text(lake.path("raw"), wholetext=True)
            .select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("raw_key"))
        )

    def curate(rows: DataFrame, batch_id: int) -> None:
        responses = with_raw_key(rows) if landed else name_parts(rows)
        batch = f"{stream}-{batch_id}"
        if ran is not None:
            ran.append(batch)
        if kind == PREVIOUS_RUNS:
            curate_previous_runs(lake, products, responses, batch)
        else:
            curate_live(lake, products, responses, batch, unit=unit)

    return (
        arrived.writeStream.queryName(f"ingest-{kind}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(curate)
        .start()
    )


def ingest(lake: Lake, products: Sequence[Product], checkpoint: str, **how) -> DataFrame:
    """Run :func:`ingest_stream` to its end and return what it has done so far, batch by batch.

    If a batch that this run worked on quarantined responses, also one that an earlier run had begun,
    it fails with all their causes, after the others have been published. What other streams refuse
    meanwhile does not concern it.
    """
    ran: list[str] = []
    query = ingest_stream(lake, products, checkpoint, **how, ran=ran)
    query.awaitTermination()
    kind = how.get("kind", LIVE)
    mine = sorted({f"{batch}-{kind}" for batch in ran})
    raise_if_quarantined(lake.quarantine().where(F.col("batch").isin(mine)))
    stream = _stream_name(lake, checkpoint, kind)
    mine = F.col("batch").startswith(f"{stream}-")
    return lake.polls().where(mine).groupBy("product", "batch").agg(
        F.count("*").alias("polls"),
        F.count_if("new_posting").alias("postings"),
        F.sum("rows").alias("rows"),
        F.sum("dropped").alias("dropped"),
    )


def _stream_name(lake: Lake, checkpoint: str, kind: str) -> str:
    """A name as old as the checkpoint."""
    mark = f"{checkpoint.rstrip('/')}/stream-name"
    if not storage.exists(lake.spark, mark):
        storage.write_text(lake.spark, mark, f"{kind}-{uuid.uuid4().hex[:12]}")
    return storage.read_text(lake.spark, mark)
