"""Report and gate keys over silver, quarantine and gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold, quality, reports as RP, validate
from . import oracle as O
from .queries_core import CFG, flagged_claims, with_gold
from .registry import register


def silver_q(spark, sf):
    flagged = flagged_claims(spark, sf)
    return gold.with_year_month(validate.accepted(flagged)), validate.quarantined(flagged)


def silver(spark, sf):
    return silver_q(spark, sf)[0]


def quarantine(spark, sf):
    return silver_q(spark, sf)[1]


def monthly(spark, sf):
    return gold.monthly_summary(silver(spark, sf))


def funnel(spark, sf):
    return gold.approval_funnel(silver(spark, sf))


def provider(spark, sf):
    return gold.provider_metrics(silver(spark, sf), CFG)


def S(body):  # noqa: N802 - oracle over silver / quarantine
    return O.with_silver(body)


R2 = "DECIMAL(5,2)"

# ------------------------------------------------------------------ silver

register("rpt_claims_by_payer", S(
    "SELECT payer_name, count(*) AS claim_count, min(claim_date) AS earliest_claim, "
    "max(claim_date) AS latest_claim FROM silver GROUP BY payer_name"))(
    lambda spark, sf: RP.claims_by_payer(silver(spark, sf)))

for _col, _key in (("claim_status", "rpt_status_share"), ("claim_type", "rpt_type_share")):
    register(_key, S(
        f"SELECT {_col}, claim_count, {O.pct_of('claim_count', 'sum(claim_count) OVER ()')} AS percentage "
        f"FROM (SELECT {_col}, count(*) AS claim_count FROM silver GROUP BY {_col})"))(
        (lambda c: lambda spark, sf: RP.share_by(silver(spark, sf), c))(_col))

register("rpt_financial_by_payer", S(
    "SELECT payer_name, count(*) AS claim_count, CAST(sum(billed_amount) AS DECIMAL(18,2)) AS total_billed, "
    "CAST(sum(allowed_amount) AS DECIMAL(18,2)) AS total_allowed, "
    f"CAST(sum(paid_amount) AS DECIMAL(18,2)) AS total_paid, {O.avg2('billed_amount')} AS avg_billed "
    "FROM silver GROUP BY payer_name"))(
    lambda spark, sf: RP.financial_by_payer(silver(spark, sf)))

register("rpt_monthly_volume", S(
    "SELECT CAST(year(claim_date) AS INTEGER) AS year, CAST(month(claim_date) AS INTEGER) AS month, "
    "count(*) AS claim_count, count(DISTINCT payer_name) AS payer_count FROM silver GROUP BY ALL"))(
    lambda spark, sf: RP.monthly_volume(silver(spark, sf)))

register("rpt_top_diagnosis", S(
    "SELECT diagnosis_code, count(*) AS claim_count FROM silver GROUP BY diagnosis_code "
    "ORDER BY claim_count DESC, diagnosis_code LIMIT 10"))(
    lambda spark, sf: RP.top_codes(silver(spark, sf), "diagnosis_code", 10))

register("rpt_top_procedure", S(
    f"SELECT procedure_code, count(*) AS claim_count, {O.avg2('billed_amount')} AS avg_billed "
    "FROM silver GROUP BY procedure_code ORDER BY claim_count DESC, procedure_code LIMIT 10"))(
    lambda spark, sf: RP.top_codes(silver(spark, sf), "procedure_code", 10, with_avg=True))

# ------------------------------------------------------------------ quarantine

register("rpt_quarantine_by_payer", S(
    "SELECT payer_name, count(*) AS quarantine_count FROM quarantine GROUP BY payer_name"))(
    lambda spark, sf: RP.quarantine_by_payer(quarantine(spark, sf)))

register("rpt_rejection_reasons", S(
    "SELECT rejection_reason, count(*) AS occurrence_count FROM "
    "(SELECT unnest(rejection_reasons) AS rejection_reason FROM quarantine) "
    "GROUP BY rejection_reason ORDER BY occurrence_count DESC, rejection_reason LIMIT 15"))(
    lambda spark, sf: RP.rejection_reasons_top(quarantine(spark, sf)))

register("rpt_rejection_by_payer", S(
    "SELECT payer_name, rejection_reason, count(*) AS count FROM "
    "(SELECT payer_name, unnest(rejection_reasons) AS rejection_reason FROM quarantine) GROUP BY ALL"))(
    lambda spark, sf: RP.rejection_by_payer(quarantine(spark, sf)))

register("rpt_quarantine_sample", S(
    "SELECT claim_id, payer_name, array_to_string(rejection_reasons, '|') AS rejection_reasons FROM quarantine "
    "ORDER BY claim_id NULLS FIRST, payer_name NULLS FIRST, array_to_string(rejection_reasons, '|') LIMIT 5"))(
    lambda spark, sf: RP.quarantine_sample(quarantine(spark, sf)).select(
        "claim_id", "payer_name", F.array_join("rejection_reasons", "|").alias("rejection_reasons")))

_GRADE_SQL = ("CASE WHEN accepted + quarantined = 0 THEN NULL "
              + " ".join(f"WHEN accepted * 100 >= (accepted + quarantined) * {lo} THEN '{name}'"
                         for lo, name in RP.GRADES)
              + f" ELSE '{RP.POOR}' END")
_COUNTS_SQL = ("(SELECT (SELECT count(*) FROM silver) AS accepted, "
               "(SELECT count(*) FROM quarantine) AS quarantined)")

register("rpt_quality_grade", S(
    f"SELECT accepted, quarantined, {O.pct_of('accepted', 'accepted + quarantined')} AS acceptance_pct, "
    f"{O.pct_of('quarantined', 'accepted + quarantined')} AS quarantine_pct, {_GRADE_SQL} AS grade "
    f"FROM {_COUNTS_SQL}"))(
    lambda spark, sf: RP.quality_grade(*silver_q(spark, sf)))

_thr = CFG.quarantine_threshold_pct
register("gate_quarantine_rate", S(
    f"SELECT accepted, quarantined, {O.pct_of('quarantined', 'accepted + quarantined')} AS quarantine_rate, "
    f"CAST({_thr} AS {R2}) AS threshold, "
    f"(accepted + quarantined = 0) OR NOT (quarantined * 100 > {_thr} * (accepted + quarantined)) AS passed "
    f"FROM {_COUNTS_SQL}"))(
    lambda spark, sf: quality.quarantine_gate(*silver_q(spark, sf), CFG))

# ------------------------------------------------------------------ gold: monthly

register("rpt_gold_monthly_list", with_gold(
    "SELECT year_month, payer_name, total_claims, unique_patients, unique_providers, "
    "total_billed_amount AS total_billed, total_paid_amount AS total_paid, approval_rate, denial_rate "
    "FROM monthly"))(lambda spark, sf: RP.gold_monthly_list(monthly(spark, sf)))

register("rpt_trend_by_month", with_gold(
    "SELECT year_month, sum(total_claims) AS total_claims, "
    "CAST(sum(total_billed_amount) AS DECIMAL(18,2)) AS total_billed, "
    "CAST(sum(total_paid_amount) AS DECIMAL(18,2)) AS total_paid, "
    f"{O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.pct_of('sum(claims_approved)', 'sum(total_claims)')} AS approval_rate_weighted FROM monthly GROUP BY year_month"))(
    lambda spark, sf: RP.trend_by_month(monthly(spark, sf)))

register("rpt_payer_compare", with_gold(
    "SELECT payer_name, sum(total_claims) AS total_claims, "
    "CAST(sum(total_billed_amount) AS DECIMAL(18,2)) AS total_billed, "
    "CAST(sum(total_paid_amount) AS DECIMAL(18,2)) AS total_paid, "
    f"{O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.avg_dec('avg_reimbursement_rate', 2, 2, R2)} AS avg_reimbursement_rate, "
    f"{O.pct_of('sum(claims_approved)', 'sum(total_claims)')} AS approval_rate_weighted "
    "FROM monthly GROUP BY payer_name"))(
    lambda spark, sf: RP.payer_compare(monthly(spark, sf)))

register("rpt_best_months", with_gold(
    "SELECT year_month, payer_name, approval_rate, total_claims FROM monthly "
    "ORDER BY approval_rate DESC, year_month, payer_name LIMIT 3"))(
    lambda spark, sf: RP.months_by_approval(monthly(spark, sf), best=True))

register("rpt_worst_months", with_gold(
    "SELECT year_month, payer_name, approval_rate, total_claims FROM monthly "
    "ORDER BY approval_rate ASC, year_month, payer_name LIMIT 3"))(
    lambda spark, sf: RP.months_by_approval(monthly(spark, sf), best=False))

register("rpt_gold_samples", with_gold(
    "SELECT year_month, payer_name, total_claims, approval_rate FROM monthly "
    "ORDER BY year_month DESC, payer_name LIMIT 5"))(
    lambda spark, sf: RP.newest(monthly(spark, sf), ["payer_name"]).select(
        "year_month", "payer_name", "total_claims", "approval_rate"))

register("rpt_funnel_samples", with_gold(
    "SELECT year_month, payer_name, claim_type, total_submitted, approval_rate FROM funnel "
    "ORDER BY year_month DESC, payer_name, claim_type LIMIT 5"))(
    lambda spark, sf: RP.newest(funnel(spark, sf), ["payer_name", "claim_type"]).select(
        "year_month", "payer_name", "claim_type", "total_submitted", "approval_rate"))

# ------------------------------------------------------------------ gold: funnel

register("rpt_funnel_by_payer_type", with_gold(
    "SELECT payer_name, claim_type, sum(total_submitted) AS total_submitted, sum(approved_count) AS approved, "
    "sum(denied_count) AS denied, sum(pending_count) AS pending, "
    f"{O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.avg_dec('denial_rate', 2, 2, R2)} AS avg_denial_rate, "
    f"{O.pct_of('sum(approved_count)', 'sum(total_submitted)')} AS approval_rate_weighted FROM funnel GROUP BY payer_name, claim_type"))(
    lambda spark, sf: RP.funnel_by_payer_type(funnel(spark, sf)))

register("rpt_inpatient_vs_outpatient", with_gold(
    "SELECT claim_type, sum(total_submitted) AS total_submitted, "
    f"{O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.avg_dec('avg_processing_days', 1, 1, 'DECIMAL(7,1)')} AS avg_processing_days, "
    "CAST(sum(submitted_amount) AS DECIMAL(18,2)) AS total_submitted_amount, "
    "CAST(sum(approved_amount) AS DECIMAL(18,2)) AS total_approved_amount, "
    f"{O.pct_of('sum(approved_count)', 'sum(total_submitted)')} AS approval_rate_weighted FROM funnel GROUP BY claim_type"))(
    lambda spark, sf: RP.inpatient_vs_outpatient(funnel(spark, sf)))

register("rpt_funnel_trend", with_gold(
    "SELECT year_month, sum(total_submitted) AS total_submitted, sum(approved_count) AS approved, "
    f"sum(denied_count) AS denied, {O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.pct_of('sum(approved_count)', 'sum(total_submitted)')} AS approval_rate_weighted FROM funnel GROUP BY year_month"))(
    lambda spark, sf: RP.funnel_trend(funnel(spark, sf)))

register("rpt_processing_efficiency", with_gold(
    f"SELECT payer_name, {O.avg_dec('avg_processing_days', 1, 1, 'DECIMAL(7,1)')} AS avg_processing_days, "
    f"{O.avg_dec('avg_reimbursement_rate_approved', 2, 2, R2)} AS avg_reimbursement_rate "
    "FROM funnel GROUP BY payer_name"))(
    lambda spark, sf: RP.processing_efficiency(funnel(spark, sf)))

# ------------------------------------------------------------------ gold: provider

register("rpt_top_providers", with_gold(
    "SELECT provider_id, total_claims, unique_patients, months_active, total_billed, total_paid, "
    "approval_rate, primary_payer, payer_count FROM provider "
    "ORDER BY total_claims DESC, provider_id LIMIT 20"))(
    lambda spark, sf: RP.top_providers(provider(spark, sf)))

register("rpt_provider_distribution", with_gold(
    "SELECT count(*) AS provider_count, "
    f"{O.avg_dec('total_claims', 0, 1, 'DECIMAL(12,1)')} AS avg_claims_per_provider, "
    f"{O.avg_dec('approval_rate', 2, 2, R2)} AS avg_approval_rate, "
    f"{O.avg_dec('avg_claim_amount', 2, 2, 'DECIMAL(10,2)')} AS avg_claim_amount FROM provider"))(
    lambda spark, sf: RP.provider_distribution(provider(spark, sf)))

register("rpt_high_performers", with_gold(
    "SELECT count_if(approval_rate >= 90) AS provider_count FROM provider"))(
    lambda spark, sf: RP.performer_count(provider(spark, sf), high=True))

register("rpt_low_performers", with_gold(
    "SELECT count_if(approval_rate < 80) AS provider_count FROM provider"))(
    lambda spark, sf: RP.performer_count(provider(spark, sf), high=False))

register("rpt_payer_mix", with_gold(
    "SELECT payer_count, count(*) AS provider_count FROM provider GROUP BY payer_count"))(
    lambda spark, sf: RP.payer_mix(provider(spark, sf)))

register("rpt_inpatient_specialists", with_gold(
    "SELECT provider_id, total_claims, inpatient_claims, outpatient_claims, "
    f"{O.pct_of('inpatient_claims', 'total_claims')} AS inpatient_pct, approval_rate FROM provider "
    "WHERE inpatient_claims * 100 > 50 * total_claims ORDER BY inpatient_claims DESC, provider_id LIMIT 10"))(
    lambda spark, sf: RP.inpatient_specialists(provider(spark, sf)))

register("rpt_provider_samples", with_gold(
    "SELECT provider_id, total_claims, approval_rate, primary_payer, top_5_diagnosis_codes, "
    "top_5_procedure_codes FROM provider ORDER BY total_claims DESC, provider_id LIMIT 5"))(
    lambda spark, sf: RP.provider_samples(provider(spark, sf))
    .withColumn("top_5_diagnosis_codes", F.array_join("top_5_diagnosis_codes", "|"))
    .withColumn("top_5_procedure_codes", F.array_join("top_5_procedure_codes", "|")))

register("rpt_gold_totals", with_gold(
    "SELECT (SELECT count(*) FROM provider) AS providers, "
    "(SELECT count(DISTINCT year_month) FROM monthly) AS months, "
    "(SELECT count(DISTINCT payer_name) FROM monthly) AS payers, "
    "(SELECT count(*) FROM monthly) AS monthly_rows, (SELECT count(*) FROM funnel) AS funnel_rows"))(
    lambda spark, sf: RP.gold_totals(monthly(spark, sf), funnel(spark, sf), provider(spark, sf)))

_RUN = "2001-06-30 18:00:00"


def _freshness(spark, sf):
    ts = F.lit(_RUN).cast("timestamp")
    out = RP.freshness(*(gold.stamp(t(spark, sf), ts) for t in (monthly, funnel, provider)))
    return out.select("table_name", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss").alias("last_update"))


register("rpt_freshness", with_gold(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CASE WHEN count(*) > 0 THEN '{_RUN}' END AS last_update FROM {table}"
    for name, table in (("claims_monthly_summary", "monthly"), ("claims_approval_funnel", "funnel"),
                        ("provider_performance_metrics", "provider")))))(_freshness)
