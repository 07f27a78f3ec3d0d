"""Compaction of silver: many small partitions of many runs become a few files.

Silver is partitioned by (claim_month, run_id), so that a run can be published,
retried and withdrawn by itself; every run and micro-batch leaves at least one
file a month.  Compaction packs a month's small partitions into bins of about
``TARGET_BYTES`` and writes each bin as one file below a run id of its own.

*Packing.*  Partitions of less than half a target are taken from the smallest
up; a bin holds those that start within one target of the month's running
total.  A bin of one partition with one file is left alone.  Only sizes and
partition names are looked at; the packing is a window over them.

*Commit.*  The rows are written first and the list of the partitions that they
replace last, as one file of ``lake.compactions``.  Readers see a compaction's
rows if its id is in that list, and hide the partitions that are in it: before
the file is there they see the old partitions, afterwards the new ones, and
never both.  The rows are counted before the list is written.  The old files
stay for readers that began before; ``vacuum`` deletes them later.

Runs that are compacted cannot be withdrawn by their log any more; their rows
keep source_file_path, ingestion_timestamp and processing_date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import upsert
from ..session import exists, store
from ..sources import files as FS
from ..sources.lake import Lake, dated_runs, read_compactions, read_silver, visible_runs
from .silver import SILVER_PARTITIONS, RunIdUsed

TARGET_BYTES = 128 * 1024 * 1024


def partition_sizes(spark: SparkSession, lake: Lake) -> DataFrame:
    """claim_month, run_id, bytes and files of the partitions that readers see."""
    files = FS.listing(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                       .option("pathGlobFilter", "*.parquet").load(lake.silver_claims))
    path = FS.plain_path(F.col("file_path"))
    sizes = (files.select(*(FS.path_part(path, c).alias(c) for c in SILVER_PARTITIONS), "file_size_bytes")
             .groupBy(*SILVER_PARTITIONS).agg(F.sum("file_size_bytes").alias("bytes"), F.count(F.lit(1)).alias("files")))
    return (sizes.join(visible_runs(spark, lake), "run_id", "left_semi")
            .join(read_compactions(spark, lake).select(*SILVER_PARTITIONS).distinct(), SILVER_PARTITIONS, "left_anti"))


def pack(sizes: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """claim_month, run_id, bin of the partitions to be rewritten."""
    month = Window.partitionBy("claim_month").orderBy("bytes", "run_id")
    placed = (sizes.filter(F.col("bytes") * 2 < target)
              .withColumn("before", F.sum("bytes").over(month.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes"))
              .withColumn("bin", F.floor(F.col("before") / target)))
    held = Window.partitionBy("claim_month", "bin")
    return (placed.withColumn("all_files", F.sum("files").over(held)).filter("all_files > 1")
            .select(*SILVER_PARTITIONS, "bin"))


class CompactionFailed(RuntimeError):
    pass


def compact(spark: SparkSession, lake: Lake, run_id: str, run_ts: _dt.datetime, target: int = TARGET_BYTES) -> dict:
    """Rewrite the small partitions of silver; the numbers of partitions replaced and of rows in them."""
    if not visible_runs(spark, lake).filter(F.col("run_id") == run_id).isEmpty():
        raise RunIdUsed(f"run {run_id} has completed; choose another id")
    nothing = {"run_id": run_id, "partitions": 0, "rows": 0}
    if not exists(spark, lake.silver_claims):
        return nothing
    upsert.drop_run(spark, lake.silver_claims, run_id)  # what a dead attempt has left
    plan = store(pack(partition_sizes(spark, lake), target), "packing")
    if plan.isEmpty():
        return nothing
    rows = read_silver(spark, lake).join(plan, SILVER_PARTITIONS)
    moved = (rows.withColumn("run_id", F.lit(run_id)).repartition("claim_month", "bin")
             .select(*schemas.SILVER_CLAIMS.fieldNames()))
    upsert.overwrite_partitions(moved, lake.silver_claims, SILVER_PARTITIONS, cluster=False)
    n = rows.count()
    written = read_silver(spark, lake, committed_only=False).filter(F.col("run_id") == run_id).count()
    if n != written:
        raise CompactionFailed(f"{written} rows were written for {n}; nothing is replaced")
    (plan.join(dated_runs(spark, lake), "run_id")
     .select(F.lit(run_id).alias("compaction_id"), "claim_month", "run_id", "processing_date",
             F.lit(run_ts).cast("timestamp").alias("event_timestamp"))
     .coalesce(1).write.mode("append").parquet(lake.compactions))
    return {"run_id": run_id, "partitions": plan.count(), "rows": n}


def vacuum(spark: SparkSession, lake: Lake, before: _dt.datetime) -> int:
    """Delete the partitions that compactions committed before that time have replaced; how many there were."""
    old = (read_compactions(spark, lake).filter(F.col("event_timestamp") < F.lit(before).cast("timestamp"))
           .select(*SILVER_PARTITIONS).distinct())
    jvm = spark.sparkContext._jvm
    n = 0
    for r in old.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(f"{lake.silver_claims}/claim_month={r.claim_month}/run_id={r.run_id}")
        n += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n
