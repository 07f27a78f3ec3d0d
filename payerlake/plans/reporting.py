"""All summary reports of a lake, written as JSON lines below ``<root>/reports``.

Reports are grouped or top-k results: at most a row per payer, month, code
rank or file state, so each is one small file.  The registry and file lists
are the exception (a row per file); they are written by as many tasks as
Spark plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators import incremental, quality
from ..operators import reports as RP
from ..session import exists
from ..sources.lake import Lake, read_log, read_quarantine, read_registry, read_silver, table_counts
from . import silver as silver_job


def all_reports(spark: SparkSession, lake: Lake, cfg: PipelineConfig = DEFAULT) -> dict[str, DataFrame]:
    """Name → report; reports of tables that do not exist yet are left out."""
    registry, log = read_registry(spark, lake), silver_job.latest_log(read_log(spark, lake))
    silver, quarantine = read_silver(spark, lake), read_quarantine(spark, lake)
    out = {
        "tables": table_counts(spark, lake),
        "registry_by_payer": registry.groupBy("payer_name").agg(
            F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("records"),
            F.sum("file_size_bytes").alias("bytes"), F.min("ingestion_timestamp").alias("first_ingestion"),
            F.max("ingestion_timestamp").alias("last_ingestion")),
        "registry_by_month": registry.groupBy("file_year", "file_month").agg(
            F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("records")),
        "registry_list": registry,
        "log_by_status": log.groupBy("status").agg(F.count(F.lit(1)).alias("files")),
        "log_by_payer": RP.log_by_payer(log), "log_recent": RP.log_recent(log), "log_failed": RP.log_failed(log),
        "run_summary": RP.run_summary(log),
        "claims_by_payer": RP.claims_by_payer(silver), "status_share": RP.share_by(silver, "claim_status"),
        "type_share": RP.share_by(silver, "claim_type"), "financial_by_payer": RP.financial_by_payer(silver),
        "monthly_volume": RP.monthly_volume(silver), "top_diagnosis": RP.top_codes(silver, "diagnosis_code"),
        "top_procedure": RP.top_codes(silver, "procedure_code", with_avg=True),
        "quarantine_by_payer": RP.quarantine_by_payer(quarantine),
        "rejection_reasons": RP.rejection_reasons_top(quarantine),
        "rejection_by_payer": RP.rejection_by_payer(quarantine), "quarantine_sample": RP.quarantine_sample(quarantine),
        "quality_grade": RP.quality_grade(silver, quarantine), "gate": quality.quarantine_gate(silver, quarantine, cfg),
    }
    if not all(exists(spark, p) for p in (lake.monthly, lake.funnel, lake.provider)):
        return out
    m, f, p = (spark.read.parquet(x) for x in (lake.monthly, lake.funnel, lake.provider))
    with_month = silver.withColumnRenamed("claim_month", "year_month")
    return out | {
        "monthly_list": RP.gold_monthly_list(m), "trend_by_month": RP.trend_by_month(m), "payer_compare": RP.payer_compare(m),
        "best_months": RP.months_by_approval(m, True), "worst_months": RP.months_by_approval(m, False),
        "funnel_by_payer_type": RP.funnel_by_payer_type(f), "inpatient_vs_outpatient": RP.inpatient_vs_outpatient(f),
        "funnel_trend": RP.funnel_trend(f), "processing_efficiency": RP.processing_efficiency(f),
        "top_providers": RP.top_providers(p), "provider_distribution": RP.provider_distribution(p),
        "high_performers": RP.performer_count(p, True), "low_performers": RP.performer_count(p, False),
        "payer_mix": RP.payer_mix(p), "inpatient_specialists": RP.inpatient_specialists(p),
        "provider_samples": RP.provider_samples(p), "freshness": RP.freshness(m, f, p), "gold_totals": RP.gold_totals(m, f, p),
        "reconciliation": incremental.reconcile_monthly(m, with_month),
    }


def write_reports(spark: SparkSession, lake: Lake, cfg: PipelineConfig = DEFAULT) -> dict[str, int]:
    """Write every report; returns their row counts."""
    rows = {}
    for name, report in all_reports(spark, lake, cfg).items():
        path = f"{lake.root}/reports/{name}"
        report.write.mode("overwrite").json(path)
        rows[name] = spark.read.schema(report.schema).json(path).count()
    return rows
