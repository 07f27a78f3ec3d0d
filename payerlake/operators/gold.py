"""The three gold aggregates.

Each is one ``groupBy().agg()`` over all requested slices at once (never a
loop over months or providers).  Partial aggregation runs map-side, so a hot
month, payer or provider is combined before the shuffle; the distinct counts
go through Catalyst's Expand rewrite, which shuffles on (group, value) and
therefore spreads a hot group over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import metrics as M

MONTHLY_KEYS = ["year_month", "payer_name"]
FUNNEL_KEYS = ["year_month", "payer_name", "claim_type"]
PROVIDER_COLUMNS = ["provider_id", "total_claims", "first_claim_date", "last_claim_date",
                    "months_active", "unique_patients", "total_billed", "total_allowed",
                    "total_paid", "avg_claim_amount", "claims_approved", "claims_denied",
                    "approval_rate", "denial_rate", "primary_payer", "payer_count",
                    "top_5_diagnosis_codes", "top_5_procedure_codes",
                    "inpatient_claims", "outpatient_claims"]


def with_year_month(df: DataFrame) -> DataFrame:
    if "year_month" in df.columns:
        return df
    return df.withColumn("year_month", M.year_month("claim_date"))


def monthly_summary(silver: DataFrame) -> DataFrame:
    """claims_monthly_summary: one row per (year_month, payer)."""
    n = F.count(F.lit(1))
    return (with_year_month(silver)
            .groupBy(*MONTHLY_KEYS)
            .agg(n.alias("total_claims"),
                 F.countDistinct("patient_id").alias("unique_patients"),
                 F.countDistinct("provider_id").alias("unique_providers"),
                 M.dsum("billed_amount").alias("total_billed_amount"),
                 M.dsum("allowed_amount").alias("total_allowed_amount"),
                 M.dsum("paid_amount").alias("total_paid_amount"),
                 M.avg2("billed_amount").alias("avg_billed_per_claim"),
                 M.avg2("paid_amount").alias("avg_paid_per_claim"),
                 F.round(F.avg(M.reimbursement_ratio(False)), 2).try_cast(M.RATE_T)
                  .alias("avg_reimbursement_rate"),
                 M.dsum(F.col("billed_amount") - F.coalesce("paid_amount", F.lit(0)))
                  .alias("total_write_off"),
                 F.count_if(M.is_approved()).alias("claims_approved"),
                 F.count_if(M.is_denied()).alias("claims_denied"),
                 F.count_if(M.is_pending()).alias("claims_pending"),
                 M.rate_of(M.is_approved()).alias("approval_rate"),
                 M.rate_of(M.is_denied()).alias("denial_rate")))


def approval_funnel(silver: DataFrame) -> DataFrame:
    """claims_approval_funnel: one row per (year_month, payer, claim_type)."""
    billed = F.col("billed_amount")
    return (with_year_month(silver)
            .groupBy(*FUNNEL_KEYS)
            .agg(F.count(F.lit(1)).alias("total_submitted"),
                 F.count_if(M.is_approved()).alias("approved_count"),
                 F.count_if(M.is_denied()).alias("denied_count"),
                 F.count_if(M.is_pending()).alias("pending_count"),
                 M.rate_of(M.is_approved()).alias("approval_rate"),
                 M.rate_of(M.is_denied()).alias("denial_rate"),
                 M.dsum(billed).alias("submitted_amount"),
                 M.dsum(F.when(M.is_approved(), billed).otherwise(F.lit(0))).alias("approved_amount"),
                 M.dsum(F.when(M.is_denied(), billed).otherwise(F.lit(0))).alias("denied_amount"),
                 F.round(F.avg(F.datediff("processing_date", "claim_date")), 1).cast(M.DAYS_T)
                  .alias("avg_processing_days"),
                 F.round(F.avg(M.reimbursement_ratio(True)), 2).try_cast(M.RATE_T)
                  .alias("avg_reimbursement_rate_approved")))


def provider_rankings(silver: DataFrame, k: int = 5) -> DataFrame:
    """Per provider: top-k diagnosis / procedure codes, primary payer, payer count.

    Diagnosis, procedure and payer values are stacked into one
    (provider, kind, value) count, so a single shuffle counts all three.  A
    row_number ≤ k filter over (provider, kind) then keeps the leaders; Spark
    pushes that limit below the window's shuffle (WindowGroupLimit), and the
    window partitions only hold one row per distinct value, never raw claims.
    Ties break on the value, so the result is deterministic.
    """
    stacked = silver.select(
        "provider_id",
        F.explode(F.array(
            F.struct(F.lit("dx").alias("kind"), F.col("diagnosis_code").alias("value")),
            F.struct(F.lit("px").alias("kind"), F.col("procedure_code").alias("value")),
            F.struct(F.lit("payer").alias("kind"), F.col("payer_name").alias("value")),
        )).alias("kv"))
    counts = (stacked.select("provider_id", "kv.kind", "kv.value")
              .filter(F.col("value").isNotNull())
              .groupBy("provider_id", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    return leading_values(counts, k)


def leading_values(counts: DataFrame, k: int) -> DataFrame:
    """Top-k codes and primary payer from (provider_id, kind, value, n)."""
    w = Window.partitionBy("provider_id", "kind").orderBy(F.col("n").desc(), F.col("value").asc())
    ranked = (counts.withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") <= k))
    return (ranked.groupBy("provider_id")
            .agg(F.sort_array(F.collect_list(F.when(F.col("kind") == "dx", F.struct("rn", "value"))))
                  .alias("_dx"),
                 F.sort_array(F.collect_list(F.when(F.col("kind") == "px", F.struct("rn", "value"))))
                  .alias("_px"),
                 F.max(F.when((F.col("kind") == "payer") & (F.col("rn") == 1), F.col("value")))
                  .alias("primary_payer"))
            .select("provider_id",
                    F.col("_dx.value").alias("top_5_diagnosis_codes"),
                    F.col("_px.value").alias("top_5_procedure_codes"),
                    "primary_payer"))


def provider_metrics(silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """provider_performance_metrics: one row per provider over all time."""
    n = F.count(F.lit(1))
    base = (silver.groupBy("provider_id")
            .agg(n.alias("total_claims"),
                 F.min("claim_date").alias("first_claim_date"),
                 F.max("claim_date").alias("last_claim_date"),
                 F.months_between(F.max("claim_date"), F.min("claim_date")).cast("int")
                  .alias("months_active"),
                 F.countDistinct("patient_id").alias("unique_patients"),
                 M.dsum("billed_amount").alias("total_billed"),
                 M.dsum("allowed_amount").alias("total_allowed"),
                 M.dsum("paid_amount").alias("total_paid"),
                 M.avg2("billed_amount").alias("avg_claim_amount"),
                 F.count_if(M.is_approved()).alias("claims_approved"),
                 F.count_if(M.is_denied()).alias("claims_denied"),
                 M.rate_of(M.is_approved()).alias("approval_rate"),
                 M.rate_of(M.is_denied()).alias("denial_rate"),
                 F.countDistinct("payer_name").cast("int").alias("payer_count"),
                 F.count_if(F.col("claim_type") == "Inpatient").alias("inpatient_claims"),
                 F.count_if(F.col("claim_type") == "Outpatient").alias("outpatient_claims")))
    ranks = provider_rankings(silver, cfg.top_codes)
    return (base.join(ranks, "provider_id", "left")
            .select(*PROVIDER_COLUMNS))


def stamp(df: DataFrame, ts=None) -> DataFrame:
    """Add last_updated_timestamp (kept out of comparable query outputs)."""
    return df.withColumn("last_updated_timestamp",
                         ts if ts is not None else F.current_timestamp())
