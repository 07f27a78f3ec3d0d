"""Mergeable partial aggregates between silver and gold.

A refresh reads silver only for the months it touches and writes three tables,
partitioned by month, that hold all that the gold tables need:

* ``measures`` – one row per (month, payer, claim type, provider): counts,
  sums, the sums and counts behind every average, first and last date;
* ``codes`` – how often a provider uses a diagnosis or procedure code in a
  month;
* ``patients`` – the distinct (payer, provider, patient) of a month, which
  keeps distinct counts exact over any union of months.  (Bitmaps of patient
  numbers would merge as well, but take 4 KB for each group and range of 32,768
  numbers, where most provider-months have a few patients.)

Sums, counts, minima and distinct rows of disjoint months merge by the same
aggregate, so the monthly summary, the approval funnel and the all-time
provider metrics are aggregates over the state: months that did not change
are never read from silver again.  Averages are divided in decimals of the
type that ``avg`` has, so they equal those over the claims.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..session import store
from . import gold

MEASURE_KEYS = ["year_month", "payer_name", "claim_type", "provider_id"]
# avg() of a decimal(10,2) and of a reimbursement ratio, a decimal(27,13).
AMOUNT_AVG_T, RATIO_SUM_T, RATIO_AVG_T = "decimal(14,6)", "decimal(38,13)", "decimal(31,17)"


def _cents(c: Column | str) -> Column:
    """An amount, a decimal(10,2), as a whole number: sums of those need no wide decimals in hash maps and shuffles."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * 100).cast("bigint")


def _sum_cents(cents: Column) -> Column:
    """``metrics.dsum`` of the amounts behind ``cents``."""
    return (F.sum(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(M.SUM_T)


# A month of a table is dealt over, and written by, up to so many tasks.
SLICES = 4


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows, once, by month and slice (a hash of ``keys``), where they are aggregated and written.

    Most groups hold one or two claims: combined before, and dealt by month again to be written, they
    take several times the room.
    """
    return rows.withColumn("slice", F.pmod(F.xxhash64(*keys), F.lit(SLICES))).repartition("year_month", "slice")


def measures(silver: DataFrame) -> DataFrame:
    billed, paid = _cents("billed_amount"), _cents("paid_amount")
    every, approved = M.reimbursement_ratio(False), M.reimbursement_ratio(True)
    days = F.datediff("processing_date", "claim_date").cast("bigint")
    rows = gold.with_year_month(silver).select(*MEASURE_KEYS, "claim_date", "processing_date", "billed_amount", "allowed_amount",
                                               "paid_amount", "claim_status")
    return _dealt(rows, *MEASURE_KEYS[1:]).groupBy(*MEASURE_KEYS, "slice").agg(
        F.count(F.lit(1)).alias("claims"),
        F.min("claim_date").alias("first_date"), F.max("claim_date").alias("last_date"),
        _sum_cents(billed).alias("billed"), F.count(billed).alias("n_billed"), _sum_cents(_cents("allowed_amount")).alias("allowed"),
        _sum_cents(paid).alias("paid"), F.count(paid).alias("n_paid"),
        _sum_cents(billed - F.coalesce(paid, F.lit(0))).alias("write_off"),
        F.count_if(M.is_approved()).alias("approved"), F.count_if(M.is_denied()).alias("denied"),
        F.count_if(M.is_pending()).alias("pending"),
        _sum_cents(F.when(M.is_approved(), billed).otherwise(F.lit(0))).alias("billed_approved"),
        _sum_cents(F.when(M.is_denied(), billed).otherwise(F.lit(0))).alias("billed_denied"),
        F.sum(every).cast(RATIO_SUM_T).alias("ratios"), F.count(every).alias("n_ratios"),
        F.sum(approved).cast(RATIO_SUM_T).alias("approved_ratios"), F.count(approved).alias("n_approved_ratios"),
        F.sum(days).alias("days"), F.count(days).alias("n_days")).drop("slice")


def codes(silver: DataFrame) -> DataFrame:
    pairs = F.array(F.struct(F.lit("dx").alias("kind"), F.col("diagnosis_code").alias("value")),
                    F.struct(F.lit("px").alias("kind"), F.col("procedure_code").alias("value")))
    rows = gold.with_year_month(silver).select("year_month", "provider_id", "diagnosis_code", "procedure_code")
    return (_dealt(rows, "provider_id").select("year_month", "provider_id", "slice", F.inline(pairs))
            .filter("value IS NOT NULL").groupBy("year_month", "provider_id", "slice", "kind", "value")
            .agg(F.count(F.lit(1)).alias("n")).drop("slice"))


def patients(silver: DataFrame) -> DataFrame:
    rows = (gold.with_year_month(silver).filter("patient_id IS NOT NULL")
            .select("year_month", "payer_name", "provider_id", "patient_id"))
    return _dealt(rows, "patient_id").distinct().drop("slice")


TABLES = {"measures": measures, "codes": codes, "patients": patients}


def _mean(total: str, n: str, kind: str) -> Column:
    """The average of what ``total`` and ``n`` sum up, as avg() of that type gives it."""
    return F.try_divide(F.sum(total), F.sum(n)).cast(kind)


def _rate(part: str) -> Column:
    return M.pct(F.sum(part), F.sum("claims"))


def _claims_of_type(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("claim_type") == kind, F.col("claims"))), F.lit(0))


def monthly_summary(measures: DataFrame, patients: DataFrame) -> DataFrame:
    """``gold.monthly_summary`` of the claims behind the state."""
    sums = measures.groupBy(*gold.MONTHLY_KEYS).agg(
        F.sum("claims").alias("total_claims"),
        M.dsum("billed").alias("total_billed_amount"), M.dsum("allowed").alias("total_allowed_amount"),
        M.dsum("paid").alias("total_paid_amount"),
        F.round(_mean("billed", "n_billed", AMOUNT_AVG_T), 2).cast(M.AVG_T).alias("avg_billed_per_claim"),
        F.round(_mean("paid", "n_paid", AMOUNT_AVG_T), 2).cast(M.AVG_T).alias("avg_paid_per_claim"),
        F.round(_mean("ratios", "n_ratios", RATIO_AVG_T), 2).try_cast(M.RATE_T).alias("avg_reimbursement_rate"),
        M.dsum("write_off").alias("total_write_off"),
        F.sum("approved").alias("claims_approved"), F.sum("denied").alias("claims_denied"),
        F.sum("pending").alias("claims_pending"),
        _rate("approved").alias("approval_rate"), _rate("denied").alias("denial_rate"))
    # Counted apart: beside a distinct count the sums would be shuffled once a provider.
    doctors = measures.groupBy(*gold.MONTHLY_KEYS).agg(F.countDistinct("provider_id").alias("unique_providers"))
    seen = patients.groupBy(*gold.MONTHLY_KEYS).agg(F.countDistinct("patient_id").alias("unique_patients"))
    same = [sums[k].eqNullSafe(doctors[k]) for k in gold.MONTHLY_KEYS]
    counted = sums.join(doctors, same).select(*(sums[c] for c in sums.columns), "unique_providers")
    return (counted.join(seen, gold.MONTHLY_KEYS, "left")
            .select(*gold.MONTHLY_KEYS, "total_claims", F.coalesce("unique_patients", F.lit(0)).alias("unique_patients"),
                    "unique_providers", *(c for c in sums.columns if c not in (*gold.MONTHLY_KEYS, "total_claims"))))


def approval_funnel(measures: DataFrame) -> DataFrame:
    """``gold.approval_funnel`` of the claims behind the state."""
    return measures.groupBy(*gold.FUNNEL_KEYS).agg(
        F.sum("claims").alias("total_submitted"), F.sum("approved").alias("approved_count"),
        F.sum("denied").alias("denied_count"), F.sum("pending").alias("pending_count"),
        _rate("approved").alias("approval_rate"), _rate("denied").alias("denial_rate"),
        M.dsum("billed").alias("submitted_amount"), M.dsum("billed_approved").alias("approved_amount"),
        M.dsum("billed_denied").alias("denied_amount"),
        F.round(F.sum("days") / F.nullif(F.sum("n_days"), F.lit(0)), 1).cast(M.DAYS_T).alias("avg_processing_days"),
        F.round(_mean("approved_ratios", "n_approved_ratios", RATIO_AVG_T), 2).try_cast(M.RATE_T)
         .alias("avg_reimbursement_rate_approved"))


def provider_metrics(measures: DataFrame, codes: DataFrame, patients: DataFrame, k: int) -> DataFrame:
    """``gold.provider_metrics`` of the claims behind the state, over all its months."""
    base = measures.groupBy("provider_id").agg(
        F.sum("claims").alias("total_claims"),
        F.min("first_date").alias("first_claim_date"), F.max("last_date").alias("last_claim_date"),
        F.months_between(F.max("last_date"), F.min("first_date")).cast("int").alias("months_active"),
        M.dsum("billed").alias("total_billed"), M.dsum("allowed").alias("total_allowed"), M.dsum("paid").alias("total_paid"),
        F.round(_mean("billed", "n_billed", AMOUNT_AVG_T), 2).cast(M.AVG_T).alias("avg_claim_amount"),
        F.sum("approved").alias("claims_approved"), F.sum("denied").alias("claims_denied"),
        _rate("approved").alias("approval_rate"), _rate("denied").alias("denial_rate"),
        F.countDistinct("payer_name").cast("int").alias("payer_count"),
        _claims_of_type("Inpatient").alias("inpatient_claims"), _claims_of_type("Outpatient").alias("outpatient_claims"))
    # Each stored by itself: the shuffles of one are gone before those of the next.
    seen = store(patients.groupBy("provider_id").agg(F.countDistinct("patient_id").alias("unique_patients")), "provider-patients")
    payers = measures.select("provider_id", F.lit("payer").alias("kind"), F.col("payer_name").alias("value"),
                             F.col("claims").alias("n")).filter("value IS NOT NULL")
    counts = (codes.select("provider_id", "kind", "value", "n").unionByName(payers)
              .groupBy("provider_id", "kind", "value").agg(F.sum("n").alias("n")))
    leaders = store(gold.leading_values(counts, k), "provider-codes")
    return (base.join(seen, "provider_id", "left").join(leaders, "provider_id", "left")
            .withColumn("unique_patients", F.coalesce("unique_patients", F.lit(0)))
            .select(*gold.PROVIDER_COLUMNS))
