"""Structured Streaming ingest: every new payer file exactly once.

The stream carries files, not rows: a ``binaryFile`` stream over the landing
folder, of which only the metadata is read.  The source remembers in the
query checkpoint which files it has delivered.  Each micro-batch registers
its files and runs the batch job's own step on them (``silver.process_files``)
with run id ``stream-<query id>-<batch id>``, so every payer folder, unknown
payers, header-only files, bad headers and all rule parameters are treated
alike in batch and stream, and a file that one of them has processed is not
processed by the other.  The query id is the one Spark writes into a new
checkpoint, so a stream that starts over has run ids of its own, whatever
folder its checkpoint is in.  A batch replayed after a failure clears its own
leftovers first; one replayed after its commit does nothing.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, PipelineConfig
from ..plans import bronze, silver
from ..session import store
from ..sources import files as FS
from ..sources.lake import Lake


def arriving_files(spark: SparkSession, lake: Lake, max_files: int) -> DataFrame:
    return FS.listing(spark.readStream.format("binaryFile").schema(FS.LISTING_SCHEMA)
                      .option("recursiveFileLookup", True)
                      .option("pathGlobFilter", FS.CSV_FILES)
                      .option("maxFilesPerTrigger", max_files)
                      .load(lake.raw))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the query's checkpoint holds from its first start on."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def start_ingest(spark: SparkSession, lake: Lake, run_ts: _dt.datetime | None = None,
                 cfg: PipelineConfig = DEFAULT, max_files: int = 1000,
                 available_now: bool = True, checkpoint: str | None = None):
    """Start the stream.  Without ``run_ts`` each batch is stamped with its own time, and its
    claims' processing date is that day."""
    where = checkpoint or f"{lake.checkpoints}/stream_ingest"

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        now = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
        own = cfg if run_ts else dataclasses.replace(cfg, as_of=now.date())
        run_id = f"stream-{query_id(session, where)}-{batch_id:06d}"
        if silver.run_completed(session, lake, run_id):
            return
        files = store(batch, "arrived")
        bronze.register_new_files(session, lake, now, files)
        todo = silver.unprocessed_files(session, lake).join(files.select("file_path"), "file_path", "left_semi")
        silver.process_files(session, lake, todo, run_id, now, own)

    writer = (arriving_files(spark, lake, max_files).writeStream.foreachBatch(publish)
              .option("checkpointLocation", where))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_ingest(spark: SparkSession, lake: Lake, run_ts: _dt.datetime | None = None,
               cfg: PipelineConfig = DEFAULT, max_files: int = 1000, checkpoint: str | None = None) -> None:
    """Consume everything currently in the landing folder, then stop."""
    q = start_ingest(spark, lake, run_ts, cfg, max_files, checkpoint=checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
