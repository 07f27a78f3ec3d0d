"""Bronze job: register every new raw file, once.

One pass per run (the original ran ≥ 3 Spark jobs per file in a driver
loop): list the landing folder (metadata only), anti-join the registry, scan
the new files once for their row counts and headers, append one registry row
per file.  Only the new files are opened; their paths pass the driver in
blocks (``files.FILES_A_SCAN``).  ``listing_start`` bounds the listing to files
written since shortly before the last registration.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import upsert
from ..session import store
from ..sources import files as FS
from ..sources.lake import Lake, read_registry

# One row per file: a small table, partitioned by payer only.
REGISTRY_PARTITIONS = ["payer_name"]


def listing_start(spark: SparkSession, lake: Lake, overlap: _dt.timedelta) -> _dt.datetime | None:
    """The last registration less ``overlap``, or None before the first.

    A file whose modification time is older than that is not listed, so the overlap has to
    cover the longest time a file may take from being written to being visible.  Files listed
    twice do no harm: known ones are left out by the registry.
    """
    last = read_registry(spark, lake).agg(F.date_format(F.max("ingestion_timestamp"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    return _dt.datetime.fromisoformat(last) - overlap if last else None


def unregistered_files(spark: SparkSession, lake: Lake, listing: DataFrame | None = None) -> DataFrame:
    listing = FS.list_files(spark, lake.raw) if listing is None else listing
    known = read_registry(spark, lake).select("file_path")
    return listing.join(known, "file_path", "left_anti")


def register_new_files(spark: SparkSession, lake: Lake, run_ts: _dt.datetime,
                       listing: DataFrame | None = None) -> DataFrame:
    """Append registry rows for unregistered files (of the landing folder, or
    of ``listing``); returns the new rows."""
    new = store(FS.describe(unregistered_files(spark, lake, listing)), "new-files")
    scanned = FS.scan_files(spark, new)
    rows = store(new.join(scanned, "file_path", "left")
                 .select("file_path", "file_name", "payer_name", "file_year", "file_month",
                         "file_size_bytes",
                         F.coalesce("record_count", F.lit(0)).cast("bigint").alias("record_count"),
                         F.lit(FS.SCHEMA_VERSION).alias("schema_version"),
                         F.lit(run_ts).cast("timestamp").alias("ingestion_timestamp"),
                         F.lit("registered").alias("processing_status"), "header_columns"), "registered")
    if not rows.isEmpty():
        upsert.append(rows, lake.registry, REGISTRY_PARTITIONS)
    return rows.select(*schemas.FILE_REGISTRY.fieldNames())
