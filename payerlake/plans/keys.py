"""The keys that silver has published, as a Bloom filter in parts.

``<lake>/silver/key_filter/bits`` holds the bitmaps, partitioned by part, and
``.../covers`` names the runs whose keys a part has; a part counts once its
covers are written.  Every run with ``dedup`` adds its part before its log
rows; a run that the parts do not cover (published without ``dedup``, or a
compaction) is added from silver when it is first needed.  ``MOST_PARTS`` parts
are merged into one.  A part of a run that never completed, or was withdrawn,
only makes the filter less sharp.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators import dedup, upsert
from ..session import exists, store
from ..sources.lake import Lake, read_silver

MOST_PARTS = 16


def _parts(spark: SparkSession, lake: Lake) -> list[str]:
    """At most MOST_PARTS names, unless a merge has died."""
    return upsert.partition_values(spark.read.parquet(lake.key_covers), "part") if exists(spark, lake.key_covers) else []


def add_part(lake: Lake, keys: DataFrame, runs: DataFrame, cfg: PipelineConfig = DEFAULT) -> None:
    """Add the keys (payer_name, claim_id) of ``runs`` (run_id)."""
    part = F.lit(f"p{uuid.uuid4().hex}").alias("part")
    upsert.append(dedup.key_filter(keys, cfg.dedup_buckets).select("bucket", "bits", part), lake.key_bits, ["part"])
    upsert.append(runs.select("run_id", part), lake.key_covers, ["part"])


def merge_parts(spark: SparkSession, lake: Lake, parts: list[str]) -> None:
    merged = F.lit(f"m{uuid.uuid4().hex}").alias("part")
    upsert.append(dedup.merged(spark.read.parquet(lake.key_bits)).select("bucket", "bits", merged), lake.key_bits, ["part"])
    upsert.append(spark.read.parquet(lake.key_covers).select("run_id").distinct().select("run_id", merged),
                  lake.key_covers, ["part"])
    for path in (lake.key_covers, lake.key_bits):
        upsert.drop_partitions(spark, parts, path, "part")


def published(spark: SparkSession, lake: Lake, new: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Those keys (payer_name, claim_id) of ``new`` that a visible run has published."""
    silver = read_silver(spark, lake)
    none = new.select(*dedup.KEYS).limit(0)
    runs = silver.select("run_id").distinct()
    if exists(spark, lake.key_covers):
        runs = runs.join(spark.read.parquet(lake.key_covers).select("run_id").distinct(), "run_id", "left_anti")
    runs = store(runs, "uncovered")
    if not runs.isEmpty():
        add_part(lake, silver.join(runs, "run_id", "left_semi").select(*dedup.KEYS), runs, cfg)
    parts = _parts(spark, lake)
    if not parts:
        return none
    if len(parts) > MOST_PARTS:
        merge_parts(spark, lake, parts)
    filters = dedup.merged(spark.read.parquet(lake.key_bits))
    maybe = store(dedup.maybe_published(new, filters, cfg.dedup_buckets), "maybe-published")
    if maybe.isEmpty():
        return none
    return silver.select(*dedup.KEYS).join(maybe, dedup.KEYS, "left_semi").distinct()
