"""Incremental gold refresh and gold ↔ silver reconciliation.

Affected slices are DataFrames, never driver lists: the months / providers
touched by recently processed claims are semi-joined to silver and the gold
aggregate is recomputed for all of them in one job.  When silver is stored
partitioned by month, the semi-join on that column lets Spark prune the
untouched partitions at runtime (dynamic partition pruning).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import metrics as M
from ..session import store
from . import gold


def since(cfg: PipelineConfig = DEFAULT) -> _dt.date:
    return cfg.as_of - _dt.timedelta(days=cfg.lookback_days)


def recent(silver: DataFrame, cutoff: _dt.date) -> DataFrame:
    return silver.filter(F.col("processing_date") >= F.lit(cutoff))


def affected_months(silver: DataFrame, cutoff: _dt.date) -> DataFrame:
    return gold.with_year_month(recent(silver, cutoff)).select("year_month").distinct()


def affected_providers(silver: DataFrame, cutoff: _dt.date) -> DataFrame:
    return recent(silver, cutoff).select("provider_id").distinct()


def vanished_months(current_gold: DataFrame, silver: DataFrame) -> DataFrame:
    """Months still in gold but no longer in silver (they must be cleared)."""
    return (current_gold.select("year_month").distinct()
            .join(gold.with_year_month(silver).select("year_month").distinct(), "year_month", "left_anti"))


def refresh_monthly(silver: DataFrame, months: DataFrame) -> DataFrame:
    sl = gold.with_year_month(silver).join(months, "year_month", "left_semi")
    return gold.monthly_summary(sl)


def refresh_funnel(silver: DataFrame, months: DataFrame) -> DataFrame:
    sl = gold.with_year_month(silver).join(months, "year_month", "left_semi")
    return gold.approval_funnel(sl)


def refresh_providers(silver: DataFrame, providers: DataFrame,
                      cfg: PipelineConfig = DEFAULT) -> DataFrame:
    sl = silver.join(providers, "provider_id", "left_semi")
    return gold.provider_metrics(sl, cfg)


def reconcile_monthly(monthly: DataFrame, silver: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Per month: gold rows vs distinct payers in silver, Σbilled gold vs silver.

    Both sides are reduced to one row per month first, then full-outer
    joined on year_month, so a month missing on either side shows up.
    """
    g = monthly.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("gold_rows"), M.dsum("total_billed_amount").alias("gold_billed"))
    s = gold.with_year_month(silver).groupBy("year_month").agg(
        F.countDistinct("payer_name").alias("silver_payers"), M.dsum("billed_amount").alias("silver_billed"))
    j = g.join(s, "year_month", "full_outer")
    gb = F.coalesce("gold_billed", F.lit(0).cast(M.SUM_T))
    sb = F.coalesce("silver_billed", F.lit(0).cast(M.SUM_T))
    diff = (gb - sb).cast(M.SUM_T)
    rows_ok = F.coalesce("gold_rows", F.lit(0)) == F.coalesce("silver_payers", F.lit(0))
    return j.select(
        "year_month",
        F.coalesce("gold_rows", F.lit(0)).cast("bigint").alias("gold_rows"),
        F.coalesce("silver_payers", F.lit(0)).cast("bigint").alias("silver_payers"),
        gb.alias("gold_billed"), sb.alias("silver_billed"), diff.alias("billed_difference"),
        (rows_ok & (F.abs(diff) <= F.lit(tolerance).cast("decimal(10,2)"))).alias("passed"))


def empty_report(spark) -> DataFrame:
    """The reconciliation report of a lake without claims."""
    return spark.createDataFrame([], "year_month string, gold_rows bigint, silver_payers bigint, gold_billed decimal(18,2), "
                                     "silver_billed decimal(18,2), billed_difference decimal(18,2), passed boolean")


class ReconciliationFailed(RuntimeError):
    pass


def enforce_reconciliation(report: DataFrame) -> None:
    """Raise when any month failed, naming the whole report's table and the number of months."""
    report = store(report, "reconciliation")
    failing = report.filter(~F.col("passed")).count()
    if failing:
        raise ReconciliationFailed(f"{failing} months fail reconciliation; report: {report.inputFiles()[0].rpartition('/')[0]}")
