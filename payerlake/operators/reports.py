"""Read-only summary reports over silver, quarantine, gold and the file log.

Each report is a small grouped / top-k plan over one table.  Top-k reports
always end with a unique sort key so their output is deterministic; Spark
plans ``orderBy().limit(k)`` as TakeOrderedAndProject (per-partition top-k,
then a k-row merge), so no full sort or single-task gather of the input.
Shares of a total use a window over the already-aggregated rows (a handful
of statuses / types), never over raw claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M


def _n() -> Column:
    return F.count(F.lit(1))


def _avg_round(c: str, scale: int, t: str) -> Column:
    return F.round(F.avg(c), scale).cast(t)


# ------------------------------------------------------------------ silver

def claims_by_payer(silver: DataFrame) -> DataFrame:
    return silver.groupBy("payer_name").agg(
        _n().alias("claim_count"), F.min("claim_date").alias("earliest_claim"),
        F.max("claim_date").alias("latest_claim"))


def share_by(silver: DataFrame, col: str) -> DataFrame:
    counts = silver.groupBy(col).agg(_n().alias("claim_count"))
    total = F.sum("claim_count").over(Window.partitionBy())
    return counts.withColumn("percentage", M.pct(F.col("claim_count"), total))


def financial_by_payer(silver: DataFrame) -> DataFrame:
    return silver.groupBy("payer_name").agg(
        _n().alias("claim_count"), M.dsum("billed_amount").alias("total_billed"),
        M.dsum("allowed_amount").alias("total_allowed"), M.dsum("paid_amount").alias("total_paid"),
        M.avg2("billed_amount").alias("avg_billed"))


def monthly_volume(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.year("claim_date").alias("year"), F.month("claim_date").alias("month")).agg(
        _n().alias("claim_count"), F.countDistinct("payer_name").alias("payer_count"))


def top_codes(silver: DataFrame, col: str, k: int = 10, with_avg: bool = False) -> DataFrame:
    aggs = [_n().alias("claim_count")]
    if with_avg:
        aggs.append(M.avg2("billed_amount").alias("avg_billed"))
    return (silver.groupBy(col).agg(*aggs)
            .orderBy(F.col("claim_count").desc(), F.col(col).asc()).limit(k))


# ------------------------------------------------------------------ quarantine

def quarantine_by_payer(q: DataFrame) -> DataFrame:
    return q.groupBy("payer_name").agg(_n().alias("quarantine_count"))


def exploded_reasons(q: DataFrame) -> DataFrame:
    return q.select("payer_name", F.explode("rejection_reasons").alias("rejection_reason"))


def rejection_reasons_top(q: DataFrame, k: int = 15) -> DataFrame:
    return (exploded_reasons(q).groupBy("rejection_reason").agg(_n().alias("occurrence_count"))
            .orderBy(F.col("occurrence_count").desc(), F.col("rejection_reason").asc()).limit(k))


def rejection_by_payer(q: DataFrame) -> DataFrame:
    return exploded_reasons(q).groupBy("payer_name", "rejection_reason").agg(_n().alias("count"))


def quarantine_sample(q: DataFrame, k: int = 5) -> DataFrame:
    """The first rejected claims by id."""
    return q.select("claim_id", "payer_name", "rejection_reasons").orderBy(
        "claim_id", "payer_name", F.array_join("rejection_reasons", "|")).limit(k)


# ------------------------------------------------------------------ quality

# Acceptance grades (lower bound in percent, label); below the last: "Poor".
GRADES = [(95, "Excellent"), (90, "Good"), (80, "Fair")]
POOR = "Poor"


def quality_counts(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """accepted / quarantined counts as one row: one aggregate over a tagged
    union of the two tables (partial counts per task, no join)."""
    tagged = (silver.select(F.lit(True).alias("ok"))
              .unionByName(quarantine.select(F.lit(False).alias("ok"))))
    return tagged.agg(F.count_if(F.col("ok")).alias("accepted"),
                      F.count_if(~F.col("ok")).alias("quarantined"))


def quality_grade(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Acceptance / quarantine shares and a grade; the grade compares the
    exact share (integer arithmetic), not the rounded one."""
    c = quality_counts(silver, quarantine)
    total = F.col("accepted") + F.col("quarantined")
    grade = None
    for lo, name in GRADES:
        cond = F.col("accepted") * 100 >= total * lo
        grade = F.when(cond, name) if grade is None else grade.when(cond, name)
    return c.select("accepted", "quarantined",
                    M.pct(F.col("accepted"), total).alias("acceptance_pct"),
                    M.pct(F.col("quarantined"), total).alias("quarantine_pct"),
                    F.when(total > 0, grade.otherwise(POOR)).alias("grade"))


# ------------------------------------------------------------------ gold

def gold_monthly_list(m: DataFrame) -> DataFrame:
    return m.select("year_month", "payer_name", "total_claims", "unique_patients", "unique_providers",
                    F.col("total_billed_amount").alias("total_billed"),
                    F.col("total_paid_amount").alias("total_paid"), "approval_rate", "denial_rate")


def trend_by_month(m: DataFrame) -> DataFrame:
    return m.groupBy("year_month").agg(
        F.sum("total_claims").alias("total_claims"), M.dsum("total_billed_amount").alias("total_billed"),
        M.dsum("total_paid_amount").alias("total_paid"),
        _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"),
        M.pct(F.sum("claims_approved"), F.sum("total_claims")).alias("approval_rate_weighted"))


def payer_compare(m: DataFrame) -> DataFrame:
    """Per payer totals; averages of monthly rates are unweighted (as the
    original report) and a claim-weighted approval rate is added."""
    return m.groupBy("payer_name").agg(
        F.sum("total_claims").alias("total_claims"), M.dsum("total_billed_amount").alias("total_billed"),
        M.dsum("total_paid_amount").alias("total_paid"),
        _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"),
        _avg_round("avg_reimbursement_rate", 2, M.RATE_T).alias("avg_reimbursement_rate"),
        M.pct(F.sum("claims_approved"), F.sum("total_claims")).alias("approval_rate_weighted"))


def months_by_approval(m: DataFrame, best: bool, k: int = 3) -> DataFrame:
    order = F.col("approval_rate").desc() if best else F.col("approval_rate").asc()
    return (m.select("year_month", "payer_name", "approval_rate", "total_claims")
            .orderBy(order, F.col("year_month").asc(), F.col("payer_name").asc()).limit(k))


def _weighted() -> Column:
    """Approval rate over all claims of the group, beside the average of its monthly rates."""
    return M.pct(F.sum("approved_count"), F.sum("total_submitted")).alias("approval_rate_weighted")


def funnel_by_payer_type(f: DataFrame) -> DataFrame:
    return f.groupBy("payer_name", "claim_type").agg(
        F.sum("total_submitted").alias("total_submitted"), F.sum("approved_count").alias("approved"),
        F.sum("denied_count").alias("denied"), F.sum("pending_count").alias("pending"),
        _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"),
        _avg_round("denial_rate", 2, M.RATE_T).alias("avg_denial_rate"), _weighted())


def inpatient_vs_outpatient(f: DataFrame) -> DataFrame:
    return f.groupBy("claim_type").agg(
        F.sum("total_submitted").alias("total_submitted"),
        _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"),
        _avg_round("avg_processing_days", 1, M.DAYS_T).alias("avg_processing_days"),
        M.dsum("submitted_amount").alias("total_submitted_amount"),
        M.dsum("approved_amount").alias("total_approved_amount"), _weighted())


def funnel_trend(f: DataFrame) -> DataFrame:
    return f.groupBy("year_month").agg(
        F.sum("total_submitted").alias("total_submitted"), F.sum("approved_count").alias("approved"),
        F.sum("denied_count").alias("denied"),
        _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"), _weighted())


def processing_efficiency(f: DataFrame) -> DataFrame:
    return f.groupBy("payer_name").agg(
        _avg_round("avg_processing_days", 1, M.DAYS_T).alias("avg_processing_days"),
        _avg_round("avg_reimbursement_rate_approved", 2, M.RATE_T).alias("avg_reimbursement_rate"))


def top_providers(p: DataFrame, k: int = 20) -> DataFrame:
    return (p.select("provider_id", "total_claims", "unique_patients", "months_active", "total_billed",
                     "total_paid", "approval_rate", "primary_payer", "payer_count")
            .orderBy(F.col("total_claims").desc(), F.col("provider_id").asc()).limit(k))


def provider_distribution(p: DataFrame) -> DataFrame:
    return p.agg(_n().alias("provider_count"),
                 F.round(F.avg("total_claims"), 1).cast("decimal(12,1)").alias("avg_claims_per_provider"),
                 _avg_round("approval_rate", 2, M.RATE_T).alias("avg_approval_rate"),
                 _avg_round("avg_claim_amount", 2, M.AVG_T).alias("avg_claim_amount"))


def performer_count(p: DataFrame, high: bool) -> DataFrame:
    cond = F.col("approval_rate") >= 90 if high else F.col("approval_rate") < 80
    return p.agg(F.count_if(cond).alias("provider_count"))


def payer_mix(p: DataFrame) -> DataFrame:
    return p.groupBy("payer_count").agg(_n().alias("provider_count"))


def inpatient_specialists(p: DataFrame, k: int = 10) -> DataFrame:
    share = M.pct(F.col("inpatient_claims"), F.col("total_claims"))
    return (p.filter(F.col("inpatient_claims") * 100.0 / F.col("total_claims") > 50)
            .select("provider_id", "total_claims", "inpatient_claims", "outpatient_claims",
                    share.alias("inpatient_pct"), "approval_rate")
            .orderBy(F.col("inpatient_claims").desc(), F.col("provider_id").asc()).limit(k))


def provider_samples(p: DataFrame, k: int = 5) -> DataFrame:
    return (p.select("provider_id", "total_claims", "approval_rate", "primary_payer",
                     "top_5_diagnosis_codes", "top_5_procedure_codes")
            .orderBy(F.col("total_claims").desc(), F.col("provider_id").asc()).limit(k))


def freshness(m: DataFrame, f: DataFrame, p: DataFrame) -> DataFrame:
    def one(df, name):
        return df.agg(F.max("last_updated_timestamp").alias("last_update")).select(
            F.lit(name).alias("table_name"), "last_update")
    return (one(m, "claims_monthly_summary").unionByName(one(f, "claims_approval_funnel"))
            .unionByName(one(p, "provider_performance_metrics")))


def gold_totals(m: DataFrame, f: DataFrame, p: DataFrame) -> DataFrame:
    """Row and key counts of the three gold tables in one aggregate."""
    none = F.lit(None).cast("string")
    tagged = (m.select(F.lit("m").alias("t"), "year_month", "payer_name")
              .unionByName(f.select(F.lit("f").alias("t"), none.alias("year_month"), none.alias("payer_name")))
              .unionByName(p.select(F.lit("p").alias("t"), none.alias("year_month"), none.alias("payer_name"))))
    t = F.col("t")
    return tagged.agg(F.count_if(t == "p").alias("providers"),
                      F.countDistinct("year_month").alias("months"),
                      F.countDistinct("payer_name").alias("payers"),
                      F.count_if(t == "m").alias("monthly_rows"),
                      F.count_if(t == "f").alias("funnel_rows"))


def newest(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    return df.orderBy(F.col("year_month").desc(), *[F.col(c).asc() for c in keys]).limit(k)


# ------------------------------------------------------------------ processing log

def log_by_payer(latest: DataFrame) -> DataFrame:
    done = latest.filter(F.col("status") == "completed")
    return done.groupBy("payer_name").agg(
        _n().alias("files_processed"), F.sum("records_read").alias("total_read"),
        F.sum("records_accepted").alias("total_accepted"),
        F.sum("records_quarantined").alias("total_quarantined"),
        M.pct(F.sum("records_accepted"), F.sum("records_read")).alias("acceptance_rate_pct"))


def log_recent(latest: DataFrame, k: int = 10) -> DataFrame:
    return (latest.orderBy(F.col("event_timestamp").desc(), "payer_name", "bronze_file_path").limit(k)
            .select("processing_id", "payer_name", "status", "records_read", "records_accepted",
                    "records_quarantined", "event_timestamp"))


def log_failed(latest: DataFrame) -> DataFrame:
    return (latest.filter(F.col("status") == "failed")
            .select("processing_id", "payer_name", "bronze_file_path", "error_message", "event_timestamp"))


def run_summary(latest: DataFrame) -> DataFrame:
    done = latest.filter(F.col("status") == "completed")
    return done.agg(_n().alias("files"), F.sum("records_accepted").alias("accepted"),
                    F.sum("records_quarantined").alias("quarantined"),
                    M.pct(F.sum("records_accepted"), F.sum("records_read")).alias("success_pct"))
