"""Incremental gold keys: affected slices, slice refresh, key upsert, reconciliation.

Scenario: the gold tables were built when silver held only the claims
processed before the look-back cutoff; the claims processed since then
arrive, the touched months / providers are recomputed and replaced.  The
result must equal a full recompute over all of silver, which is exactly
what the oracle computes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold, incremental, upsert
from ..sources.lake import Lake
from . import oracle as O
from .queries_core import CFG, MONTHLY_SQL, FUNNEL_SQL, PROVIDER_SQL, provider_out, silver_claims, with_gold
from .registry import register

CUTOFF = incremental.since(CFG)
_C = f"DATE '{CUTOFF.isoformat()}'"


register("affected_months", O.with_silver(
    f"SELECT DISTINCT year_month FROM silver WHERE processing_date >= {_C}"))(
    lambda spark, sf: incremental.affected_months(silver_claims(spark, sf), CUTOFF))

register("affected_providers", O.with_silver(
    f"SELECT DISTINCT provider_id FROM silver WHERE processing_date >= {_C}"))(
    lambda spark, sf: incremental.affected_providers(silver_claims(spark, sf), CUTOFF))


def _slice_refresh(spark, sf, build, refresh):
    silver = silver_claims(spark, sf)
    lake = Lake.scratch(spark, "gold-inc")
    path = f"{lake.root}/table"
    before = silver.filter(F.col("processing_date") < F.lit(CUTOFF))
    upsert.overwrite_partitions(build(before), path, ["year_month"], cluster=True)
    months = incremental.affected_months(silver, CUTOFF)
    upsert.overwrite_partitions(refresh(silver, months), path, ["year_month"], cluster=True)
    return spark.read.parquet(path)


register("gold_monthly_incremental", O.with_silver(MONTHLY_SQL))(
    lambda spark, sf: _slice_refresh(spark, sf, gold.monthly_summary, incremental.refresh_monthly))

register("gold_funnel_incremental", O.with_silver(FUNNEL_SQL))(
    lambda spark, sf: _slice_refresh(spark, sf, gold.approval_funnel, incremental.refresh_funnel))


@register("provider_upsert", "WITH " + O.silver_ctes() + PROVIDER_SQL)
def q_provider_upsert(spark, sf):
    silver = silver_claims(spark, sf)
    lake = Lake.scratch(spark, "provider-upsert")
    before = gold.provider_metrics(silver.filter(F.col("processing_date") < F.lit(CUTOFF)), CFG)
    before.write.parquet(f"{lake.root}/current")
    current = spark.read.parquet(f"{lake.root}/current")
    fresh = incremental.refresh_providers(silver, incremental.affected_providers(silver, CUTOFF), CFG)
    return provider_out(upsert.replace_keys(current, fresh, "provider_id"))


@register("reconcile_monthly", with_gold(
    "SELECT coalesce(g.year_month, s.year_month) AS year_month, coalesce(gold_rows, 0) AS gold_rows, "
    "coalesce(silver_payers, 0) AS silver_payers, "
    "CAST(coalesce(gold_billed, 0) AS DECIMAL(18,2)) AS gold_billed, "
    "CAST(coalesce(silver_billed, 0) AS DECIMAL(18,2)) AS silver_billed, "
    "CAST(coalesce(gold_billed, 0) - coalesce(silver_billed, 0) AS DECIMAL(18,2)) AS billed_difference, "
    "coalesce(gold_rows, 0) = coalesce(silver_payers, 0) "
    "AND abs(coalesce(gold_billed, 0) - coalesce(silver_billed, 0)) <= 0.01 AS passed "
    "FROM (SELECT year_month, count(*) AS gold_rows, CAST(sum(total_billed_amount) AS DECIMAL(18,2)) AS gold_billed "
    "      FROM monthly GROUP BY year_month) g "
    "FULL OUTER JOIN (SELECT year_month, count(DISTINCT payer_name) AS silver_payers, "
    "      CAST(sum(billed_amount) AS DECIMAL(18,2)) AS silver_billed FROM silver GROUP BY year_month) s "
    "ON g.year_month = s.year_month"))
def q_reconcile(spark, sf):
    silver = silver_claims(spark, sf)
    return incremental.reconcile_monthly(gold.monthly_summary(silver), silver)


@register("reconcile_planted_error", with_gold(
    "SELECT year_month, count(*) = 1 AS one_payer_less, false AS passed FROM monthly "
    "WHERE payer_name = 'payer_a' AND CAST(substr(year_month, 6, 2) AS INTEGER) = 3 GROUP BY year_month"))
def q_reconcile_planted(spark, sf):
    """Gold without payer_a's March rows: exactly those months must fail."""
    silver = silver_claims(spark, sf)
    planted = gold.monthly_summary(silver).filter(~((F.col("payer_name") == "payer_a") & F.col("year_month").endswith("-03")))
    report = incremental.reconcile_monthly(planted, silver).filter(~F.col("passed"))
    return report.select("year_month", (F.col("gold_rows") == F.col("silver_payers") - 1).alias("one_payer_less"), "passed")
