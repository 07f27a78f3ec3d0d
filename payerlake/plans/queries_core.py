"""Core keys: claims view, validation rules, silver split, gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE
from ..functions import rules as R
from ..operators import gold, validate
from ..sources.claims_fixture import CLAIM_COLUMNS, claims_table, claims_view
from . import oracle as O
from .registry import register

CFG = FIXTURE


def flagged_claims(spark: SparkSession, sf: str) -> DataFrame:
    return validate.with_reasons(claims_table(spark, sf), CFG)


def silver_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted claims with the partition column ``year_month``."""
    return gold.with_year_month(validate.accepted(flagged_claims(spark, sf)))


def joined(col: str, sep: str = "|"):
    return F.array_join(F.col(col), sep).alias(col)


# ------------------------------------------------------------------ claims


@register("claims_view", O.with_silver(f"SELECT {O.CLAIM_COLS} FROM claims"))
def q_claims_view(spark, sf):
    return claims_view(spark, sf)


# ------------------------------------------------------------------ rules

def _family_key(family: str):
    def build(spark, sf):
        df = claims_table(spark, sf).withColumn(
            "reasons", R.rejection_reasons(CFG, (family,)))
        return (df.filter(F.size("reasons") > 0)
                .select("claim_id", "payer_name", joined("reasons")))
    sql = O.with_silver(
        f"SELECT claim_id, payer_name, array_to_string(r, '|') AS reasons FROM "
        f"(SELECT claim_id, payer_name, {O.reasons_sql((family,))} AS r FROM claims) "
        f"WHERE len(r) > 0")
    register(f"rule_{family}", sql)(build)


for _fam in R.REASON_FAMILIES:
    _family_key(_fam)


@register("rejection_reasons", O.with_silver(
    "SELECT claim_id, payer_name, array_to_string(rejection_reasons, '|') AS rejection_reasons, "
    "CAST(len(rejection_reasons) AS INTEGER) AS n_reasons FROM flagged"))
def q_rejection_reasons(spark, sf):
    return flagged_claims(spark, sf).select(
        "claim_id", "payer_name", joined("rejection_reasons"),
        F.size("rejection_reasons").alias("n_reasons"))


@register("valid_rows", O.with_silver(f"SELECT {O.CLAIM_COLS} FROM silver"))
def q_valid_rows(spark, sf):
    return silver_claims(spark, sf).select(*CLAIM_COLUMNS)


_QCOLS = validate.QUARANTINE_STRING_COLUMNS


@register("quarantine_rows", O.with_silver(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _QCOLS)
    + ", payer_name, array_to_string(rejection_reasons, '|') AS rejection_reasons FROM quarantine"))
def q_quarantine_rows(spark, sf):
    q = validate.quarantine_projection(validate.quarantined(flagged_claims(spark, sf)))
    return q.select(*_QCOLS, "payer_name", joined("rejection_reasons"))


# ------------------------------------------------------------------ gold

MONTHLY_SQL = f"""
SELECT year_month, payer_name,
  count(*) AS total_claims,
  count(DISTINCT patient_id) AS unique_patients,
  count(DISTINCT provider_id) AS unique_providers,
  CAST(sum(billed_amount) AS DECIMAL(18,2)) AS total_billed_amount,
  CAST(sum(allowed_amount) AS DECIMAL(18,2)) AS total_allowed_amount,
  CAST(sum(paid_amount) AS DECIMAL(18,2)) AS total_paid_amount,
  {O.avg2('billed_amount')} AS avg_billed_per_claim,
  {O.avg2('paid_amount')} AS avg_paid_per_claim,
  {O.avg_e13('reimb')} AS avg_reimbursement_rate,
  CAST(sum(billed_amount - coalesce(paid_amount, 0)) AS DECIMAL(18,2)) AS total_write_off,
  count_if(claim_status = 'Approved') AS claims_approved,
  count_if(claim_status = 'Denied') AS claims_denied,
  count_if(claim_status IN ('Pending', 'Under Review')) AS claims_pending,
  {O.rate("claim_status = 'Approved'")} AS approval_rate,
  {O.rate("claim_status = 'Denied'")} AS denial_rate
FROM (SELECT *, CASE WHEN billed_amount > 0 THEN {O.ratio_e13('paid_amount', 'billed_amount')}
                     ELSE 0 END AS reimb FROM silver)
GROUP BY year_month, payer_name"""


@register("gold_monthly_summary", O.with_silver(MONTHLY_SQL))
def q_gold_monthly(spark, sf):
    return gold.monthly_summary(silver_claims(spark, sf))


FUNNEL_SQL = f"""
SELECT year_month, payer_name, claim_type,
  count(*) AS total_submitted,
  count_if(claim_status = 'Approved') AS approved_count,
  count_if(claim_status = 'Denied') AS denied_count,
  count_if(claim_status IN ('Pending', 'Under Review')) AS pending_count,
  {O.rate("claim_status = 'Approved'")} AS approval_rate,
  {O.rate("claim_status = 'Denied'")} AS denial_rate,
  CAST(sum(billed_amount) AS DECIMAL(18,2)) AS submitted_amount,
  CAST(sum(CASE WHEN claim_status = 'Approved' THEN billed_amount ELSE 0 END) AS DECIMAL(18,2)) AS approved_amount,
  CAST(sum(CASE WHEN claim_status = 'Denied' THEN billed_amount ELSE 0 END) AS DECIMAL(18,2)) AS denied_amount,
  {O.avg1_int('days')} AS avg_processing_days,
  {O.avg_e13('reimb')} AS avg_reimbursement_rate_approved
FROM (SELECT *, datediff('day', claim_date, processing_date) AS days,
             CASE WHEN claim_status = 'Approved' AND billed_amount > 0
                  THEN {O.ratio_e13('paid_amount', 'billed_amount')} END AS reimb
      FROM silver)
GROUP BY year_month, payer_name, claim_type"""


@register("gold_funnel", O.with_silver(FUNNEL_SQL))
def q_gold_funnel(spark, sf):
    return gold.approval_funnel(silver_claims(spark, sf))


PROVIDER_RANKS_CTE = f"""
stacked AS (
  SELECT provider_id, 'dx' AS kind, diagnosis_code AS value FROM silver
  UNION ALL SELECT provider_id, 'px', procedure_code FROM silver
  UNION ALL SELECT provider_id, 'payer', payer_name FROM silver
),
kcounts AS (
  SELECT provider_id, kind, value, count(*) AS n FROM stacked WHERE value IS NOT NULL
  GROUP BY provider_id, kind, value
),
kranked AS (
  SELECT *, row_number() OVER (PARTITION BY provider_id, kind ORDER BY n DESC, value ASC) AS rn
  FROM kcounts
),
ranks AS (
  SELECT provider_id,
    string_agg(CASE WHEN kind = 'dx' THEN value END, '|' ORDER BY rn) AS top_5_diagnosis_codes,
    string_agg(CASE WHEN kind = 'px' THEN value END, '|' ORDER BY rn) AS top_5_procedure_codes,
    max(CASE WHEN kind = 'payer' AND rn = 1 THEN value END) AS primary_payer
  FROM kranked WHERE rn <= {CFG.top_codes} GROUP BY provider_id
)"""

PROVIDER_PRE = f""",
{PROVIDER_RANKS_CTE},
base AS (
  SELECT provider_id,
    count(*) AS total_claims,
    min(claim_date) AS first_claim_date,
    max(claim_date) AS last_claim_date,
    {O.months_between_int('max(claim_date)', 'min(claim_date)')} AS months_active,
    count(DISTINCT patient_id) AS unique_patients,
    CAST(sum(billed_amount) AS DECIMAL(18,2)) AS total_billed,
    CAST(sum(allowed_amount) AS DECIMAL(18,2)) AS total_allowed,
    CAST(sum(paid_amount) AS DECIMAL(18,2)) AS total_paid,
    {O.avg2('billed_amount')} AS avg_claim_amount,
    count_if(claim_status = 'Approved') AS claims_approved,
    count_if(claim_status = 'Denied') AS claims_denied,
    {O.rate("claim_status = 'Approved'")} AS approval_rate,
    {O.rate("claim_status = 'Denied'")} AS denial_rate,
    CAST(count(DISTINCT payer_name) AS INTEGER) AS payer_count,
    count_if(claim_type = 'Inpatient') AS inpatient_claims,
    count_if(claim_type = 'Outpatient') AS outpatient_claims
  FROM silver GROUP BY provider_id
)"""

PROVIDER_SELECT = """SELECT b.provider_id, total_claims, first_claim_date, last_claim_date, months_active,
  unique_patients, total_billed, total_allowed, total_paid, avg_claim_amount,
  claims_approved, claims_denied, approval_rate, denial_rate, primary_payer, payer_count,
  top_5_diagnosis_codes, top_5_procedure_codes, inpatient_claims, outpatient_claims
FROM base b LEFT JOIN ranks r ON b.provider_id = r.provider_id"""

PROVIDER_SQL = PROVIDER_PRE + "\n" + PROVIDER_SELECT

# silver + the three gold tables as CTEs (monthly, funnel, provider)
GOLD_CTES = (O.silver_ctes() + ",\nmonthly AS (" + MONTHLY_SQL + "\n),\nfunnel AS (" + FUNNEL_SQL
             + "\n)" + PROVIDER_PRE + ",\nprovider AS (" + PROVIDER_SELECT + ")")


def with_gold(body: str) -> str:
    return "WITH " + GOLD_CTES + "\n" + body


def provider_out(df: DataFrame) -> DataFrame:
    return df.withColumn("top_5_diagnosis_codes", F.array_join("top_5_diagnosis_codes", "|")) \
             .withColumn("top_5_procedure_codes", F.array_join("top_5_procedure_codes", "|"))


@register("gold_provider", "WITH " + O.silver_ctes() + PROVIDER_SQL)
def q_gold_provider(spark, sf):
    return provider_out(gold.provider_metrics(silver_claims(spark, sf), CFG))


@register("gold_provider_top_codes", "WITH " + O.silver_ctes() + ",\n" + PROVIDER_RANKS_CTE
          + "\nSELECT provider_id, top_5_diagnosis_codes, top_5_procedure_codes, primary_payer FROM ranks")
def q_gold_provider_top_codes(spark, sf):
    return provider_out(gold.provider_rankings(silver_claims(spark, sf), CFG.top_codes))
