"""Analytical operators described by the design documents.

All are DataFrame plans over silver or gold:

* ``dedup_claims`` – one survivor per (payer, claim id): a single hash/sort
  aggregate taking the max of a struct ordered by recency then by every
  other column (deterministic, and a hot claim id is combined map-side
  instead of being gathered into one window partition).
* ``claims_by_term`` – glossary term → ICD-10 code of any length, an equi-join
  on the code's prefixes of the lengths that the glossary has.
* ``high_cost_*`` – threshold filter, top-k report and per-payer totals.
* ``avg_by_payer_quarter`` – calendar-quarter averages.
* ``approval_change`` / ``approval_anomalies`` / ``payer_rank`` – windows
  over the monthly gold table (months × payers rows, never raw claims).
* ``mask_patients`` – salted SHA-256 pseudonym of the patient id.
* ``claims_star`` – provider geography: claims pre-aggregated per provider
  before joining the supplier → nation → region dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import metrics as M

# ---- fixed values: glossary of terms → ICD-10 category (3 characters) -----
GLOSSARY = [
    ("diabetes", "E11"),
    ("asthma", "J45"),
    ("bacterial pneumonia", "J15"),
    ("chronic kidney disease", "N18"),
    ("knee osteoarthritis", "M17"),
    ("recurrent depression", "F33"),
    ("prostate cancer", "C61"),
    ("heart block", "I44"),
]
HIGH_COST_THRESHOLD = 10000
SHARP_DROP_PCT = 25
OUTLIER_SIGMAS = 2
TRAILING_MONTHS = 6
MIN_HISTORY = 3
# ---------------------------------------------------------------------------


def dedup_claims(claims: DataFrame, order_cols: tuple[str, ...] = ("processing_date",)) -> DataFrame:
    keys = ["payer_name", "claim_id"]
    rest = [c for c in claims.columns if c not in keys and c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in list(order_cols) + rest]))
    return claims.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*").select(*claims.columns)


def glossary_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GLOSSARY, "term string, icd10_category string")


def claims_by_term(silver: DataFrame, glossary: DataFrame) -> DataFrame:
    """Claims whose diagnosis starts with a term's code; a term may have several codes."""
    # Codes have a handful of lengths, whatever the number of terms.
    sizes = [r.n for r in glossary.select(F.length("icd10_category").alias("n")).distinct().orderBy("n").collect() if r.n]
    code = F.col("diagnosis_code")
    prefixes = F.array_compact(F.array(*(F.when(F.length(code) >= n, F.substring(code, 1, n)) for n in sizes))) \
        if sizes else F.array().cast("array<string>")
    j = silver.select("*", F.explode(prefixes).alias("icd10_category")).join(glossary, "icd10_category")
    return j.groupBy("term", "icd10_category", "payer_name").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(M.is_approved()).alias("claims_approved"),
        M.rate_of(M.is_approved()).alias("approval_rate"),
        M.dsum("billed_amount").alias("total_billed"))


def high_cost(silver: DataFrame, threshold=HIGH_COST_THRESHOLD) -> DataFrame:
    return silver.filter(F.col("billed_amount") > F.lit(threshold))


def high_cost_top(silver: DataFrame, k: int = 20) -> DataFrame:
    cols = ["claim_id", "payer_name", "provider_id", "diagnosis_code", "claim_status", "billed_amount"]
    order = [F.col("billed_amount").desc()] + [F.col(c).asc() for c in cols if c != "billed_amount"]
    return high_cost(silver).select(*cols).orderBy(*order).limit(k)


def high_cost_by_payer(silver: DataFrame) -> DataFrame:
    return high_cost(silver).groupBy("payer_name").agg(
        F.count(F.lit(1)).alias("high_cost_claims"), M.dsum("billed_amount").alias("high_cost_billed"),
        M.avg2("billed_amount").alias("avg_high_cost"))


def avg_by_payer_quarter(silver: DataFrame) -> DataFrame:
    return silver.groupBy("payer_name", F.year("claim_date").alias("year"),
                          F.quarter("claim_date").alias("quarter")).agg(
        F.count(F.lit(1)).alias("total_claims"), M.avg2("billed_amount").alias("avg_claim_amount"))


def _payer_months():
    return Window.partitionBy("payer_name").orderBy("year_month")


def approval_change(monthly: DataFrame) -> DataFrame:
    prev = F.lag("approval_rate").over(_payer_months())
    m = monthly.select("payer_name", "year_month", "approval_rate").withColumn("prev_approval_rate", prev)
    diff = F.col("approval_rate") - F.col("prev_approval_rate")
    return m.select("payer_name", "year_month", "approval_rate", "prev_approval_rate",
                    diff.cast("decimal(6,2)").alias("change_points"),
                    F.round(diff * 100 / F.nullif(F.col("prev_approval_rate"), F.lit(0)), 2)
                    .cast("decimal(12,2)").alias("change_pct"))


def approval_anomalies(monthly: DataFrame) -> DataFrame:
    """Flag months whose approval rate is an outlier against the trailing
    months (|x − mean| > 2·sd, exact integer test) or dropped > 25 %."""
    w = _payer_months().rowsBetween(-TRAILING_MONTHS, -1)
    x = F.col("approval_rate")
    h = monthly.select("payer_name", "year_month", "approval_rate",
                       F.count(x).over(w).alias("n_prior"),
                       F.sum(x).over(w).alias("s1"),
                       F.sum(x * x).over(w).alias("s2"),
                       F.lag(x).over(_payer_months()).alias("prev"))
    n, s1, s2 = F.col("n_prior"), F.col("s1"), F.col("s2")
    # (n·x − S1)² · (n − 1) > k² · n · (n·S2 − S1²)  ⇔  |x − mean| > k · sample sd
    lhs = (n * x - s1) * (n * x - s1) * (n - 1)
    rhs = F.lit(OUTLIER_SIGMAS * OUTLIER_SIGMAS) * n * (n * s2 - s1 * s1)
    outlier = F.coalesce((n >= MIN_HISTORY) & (lhs > rhs), F.lit(False))
    drop = F.coalesce((F.col("prev") - x) * 100 > F.col("prev") * SHARP_DROP_PCT, F.lit(False))
    return h.select("payer_name", "year_month", "approval_rate", "n_prior",
                    F.round(s1 / n, 2).cast(M.RATE_T).alias("trailing_mean"),
                    outlier.alias("is_outlier"), drop.alias("is_sharp_drop"),
                    (outlier | drop).alias("is_anomaly"))


def payer_rank(monthly: DataFrame, months: int = TRAILING_MONTHS) -> DataFrame:
    """Rank payers by claim-weighted approval over the latest ``months`` months."""
    latest = F.max("year_month").over(Window.partitionBy())
    first = F.date_format(F.add_months(F.to_date(F.concat(latest, F.lit("-01"))), -(months - 1)), "yyyy-MM")
    recent = monthly.withColumn("_first", first).filter(F.col("year_month") >= F.col("_first"))
    agg = recent.groupBy("payer_name").agg(
        F.sum("total_claims").alias("total_claims"), F.sum("claims_approved").alias("claims_approved"),
        M.pct(F.sum("claims_approved"), F.sum("total_claims")).alias("approval_rate"))
    return agg.select("*",
                      F.dense_rank().over(Window.orderBy(F.col("approval_rate").desc())).alias("rank_top"),
                      F.dense_rank().over(Window.orderBy(F.col("approval_rate").asc())).alias("rank_bottom"))


def mask_patients(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    masked = F.sha2(F.concat(F.lit(cfg.mask_salt), F.col("patient_id")), 256)
    return df.withColumn("patient_id", masked)


def claims_star(silver: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    per_provider = silver.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("billed_amount").alias("billed"),
        F.count_if(M.is_approved()).alias("approved"))
    sup = supplier.select(F.col("s_suppkey").cast("string").alias("provider_id"), "s_nationkey")
    geo = (per_provider.join(sup, "provider_id")
           .join(nation.select("n_nationkey", "n_name", "n_regionkey"),
                 F.col("s_nationkey") == F.col("n_nationkey"))
           .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")))
    return geo.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("providers"), F.sum("claims").alias("total_claims"),
        M.dsum("billed").alias("total_billed"), F.sum("approved").alias("claims_approved"),
        M.pct(F.sum("approved"), F.sum("claims")).alias("approval_rate"))

