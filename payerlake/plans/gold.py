"""Gold job: refresh the three aggregates for the slices touched recently.

1. The log names the runs of the look-back window; their partitions of silver
   (``run_id`` is a partition column) give the touched months and providers.
   Months whose number of claims is not that of the state are touched as well.
2. The partial aggregates (``operators/gold_state.py``) of the touched months
   are recomputed from silver, which is read for these months only and three
   times, each time with the few columns of one table.
3. The monthly tables are merged from the state of the touched months, and the
   metrics of the touched providers from the state of all months.  The provider
   table is spread over ``PROVIDER_BUCKETS`` hash buckets; of a touched bucket
   the other providers' rows are carried over as they are.

Each table is replaced by one dynamic-partition overwrite – no DELETE, no loop
over months.  The touched providers are noted before the state changes and
struck off when gold is written, so a refresh that died in between is made up
for by the next one.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators import gold, gold_state, incremental, upsert
from ..session import exists, store
from ..sources.lake import Lake, dated_runs, read_silver

PROVIDER_BUCKETS = 100


def provider_bucket(c="provider_id"):
    return F.pmod(F.xxhash64(F.col(c)), F.lit(PROVIDER_BUCKETS)).cast("int")


def silver_for_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_silver(spark, lake).withColumnRenamed("claim_month", "year_month")


def read_state(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return spark.read.parquet(lake.state(table))


def changed_months(measures: DataFrame, silver: DataFrame) -> DataFrame:
    """year_month and gone (no claims left) of the months whose number of claims differs from the state's.

    Finds what the look-back window does not: withdrawn runs, late runs of an older day.  Of silver
    only a partition column is read.
    """
    had = measures.groupBy("year_month").agg(F.sum("claims").alias("had"))
    has = silver.groupBy("year_month").agg(F.count(F.lit(1)).alias("has"))
    return (had.join(has, "year_month", "full_outer").filter("NOT had <=> has")
            .select("year_month", F.col("has").isNull().alias("gone")))


def refresh_state(spark: SparkSession, lake: Lake, silver: DataFrame, months: DataFrame, gone: list[str]) -> None:
    """Recompute the state of ``months`` and drop that of the months that have ``gone``; its rows are dealt by month already."""
    touched = silver.join(months, "year_month", "left_semi")
    for table, build in gold_state.TABLES.items():
        upsert.overwrite_partitions(build(touched), lake.state(table), ["year_month"], cluster=False)
        upsert.drop_partitions(spark, gone, lake.state(table), "year_month")


def run_gold(spark: SparkSession, lake: Lake, run_ts: _dt.datetime,
             cfg: PipelineConfig = DEFAULT, full: bool = False) -> DataFrame:
    """Refresh gold; returns the month reconciliation report."""
    silver = silver_for_gold(spark, lake)
    if silver.isEmpty() and not exists(spark, lake.monthly):
        return incremental.empty_report(spark)
    ts = F.lit(run_ts).cast("timestamp")
    known = exists(spark, lake.state("measures"))
    cutoff = incremental.since(cfg) if known and not full else _dt.date(1900, 1, 1)
    runs = dated_runs(spark, lake).filter(F.col("processing_date") >= F.lit(cutoff))
    recent = silver.join(F.broadcast(runs), "run_id", "left_semi")
    months, gone = recent.select("year_month").distinct(), []
    providers = recent.select("provider_id")
    if known:
        before = read_state(spark, lake, "measures")
        changed = store(changed_months(before, silver), "changed")
        gone = upsert.partition_values(changed.filter("gone"), "year_month")
        months = months.unionByName(changed.filter("NOT gone").select("year_month")).distinct()
    # A small set that several steps use.
    months = store(months, "months")
    if known:
        old = before.join(months.unionByName(changed.filter("gone").select("year_month")), "year_month", "left_semi")
        new = silver.join(changed, "year_month", "left_semi")
        providers = providers.unionByName(old.select("provider_id")).unionByName(new.select("provider_id"))
    upsert.append(providers.distinct(), lake.state("pending"))
    refresh_state(spark, lake, silver, months, gone)
    measures, codes, patients = (read_state(spark, lake, t) for t in gold_state.TABLES)

    def of_months(table: DataFrame) -> DataFrame:
        return table.join(months, "year_month", "left_semi")

    monthly = gold.stamp(gold_state.monthly_summary(of_months(measures), of_months(patients)), ts)
    upsert.overwrite_partitions(monthly, lake.monthly, ["year_month"])
    funnel = gold.stamp(gold_state.approval_funnel(of_months(measures)), ts)
    upsert.overwrite_partitions(funnel, lake.funnel, ["year_month"])
    for path in (lake.monthly, lake.funnel):
        upsert.drop_partitions(spark, gone, path, "year_month")
    refresh_providers(spark, lake, measures, codes, patients, ts, cfg)
    return incremental.reconcile_monthly(spark.read.parquet(lake.monthly), silver)


def refresh_providers(spark: SparkSession, lake: Lake, measures: DataFrame, codes: DataFrame, patients: DataFrame,
                      ts, cfg: PipelineConfig) -> None:
    """Merge the state of the pending providers, and replace their buckets."""
    touched = store(spark.read.parquet(lake.state("pending")).distinct(), "providers")

    def of_touched(table: DataFrame) -> DataFrame:
        return table.join(touched, "provider_id", "left_semi")

    fresh = gold.stamp(gold_state.provider_metrics(of_touched(measures), of_touched(codes), of_touched(patients),
                                                   cfg.top_codes), ts)
    fresh = fresh.withColumn("provider_bucket", provider_bucket())
    buckets = touched.select(provider_bucket().alias("provider_bucket")).distinct()
    if exists(spark, lake.provider):
        others = (spark.read.parquet(lake.provider).join(buckets, "provider_bucket", "left_semi")
                  .join(touched, "provider_id", "left_anti"))
        # A copy: the buckets are about to be replaced.
        fresh = fresh.unionByName(others.select(*fresh.columns))
    fresh = store(fresh, "fresh-providers")
    if exists(spark, lake.provider):
        empty = buckets.join(fresh.select("provider_bucket").distinct(), "provider_bucket", "left_anti")
        upsert.drop_partitions(spark, upsert.partition_values(empty, "provider_bucket"), lake.provider, "provider_bucket")
    upsert.overwrite_partitions(fresh, lake.provider, ["provider_bucket"])
    upsert.clear(spark, lake.state("pending"))
