"""Validation: attach reasons, split accepted / quarantined rows.

One projection computes every reason; the two outputs are two filters over
the same (optionally persisted) DataFrame, so the source is read once per
write when the caller persists it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import rules

QUARANTINE_STRING_COLUMNS = [
    "claim_id", "patient_id", "provider_id", "claim_date", "service_from_date",
    "service_to_date", "admission_date", "discharge_date", "diagnosis_code",
    "procedure_code", "billed_amount", "allowed_amount", "paid_amount",
    "claim_status", "claim_type",
]


def with_reasons(df: DataFrame, cfg: PipelineConfig = DEFAULT,
                 families=rules.REASON_FAMILIES) -> DataFrame:
    return df.withColumn("rejection_reasons", rules.rejection_reasons(cfg, families))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size("rejection_reasons") == 0).drop("rejection_reasons")


def quarantined(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size("rejection_reasons") > 0)


def split(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    flagged = with_reasons(df, cfg)
    return accepted(flagged), quarantined(flagged)


def quarantine_projection(q: DataFrame, rejected_at: Column | None = None,
                          raw_cols: list[str] | None = None) -> DataFrame:
    """Quarantine table layout: claim columns as strings, reasons, raw JSON.

    ``raw_record`` keeps the original wire values (when the caller passes
    the raw column names) so an unparseable input is not lost.
    """
    rejected_at = rejected_at if rejected_at is not None else F.current_timestamp()
    cols = [F.col(c).cast("string").alias(c) for c in QUARANTINE_STRING_COLUMNS]
    if raw_cols:
        raw = F.to_json(F.struct(*[F.col(c) for c in raw_cols]))
    elif "raw_record" in q.columns:  # the file reader already serialised the wire row
        raw = F.col("raw_record")
    else:
        raw = F.lit(None).cast("string")
    src = F.col("source_file_path") if "source_file_path" in q.columns else F.lit(None).cast("string")
    return q.select(
        *cols,
        F.col("payer_name"),
        src.alias("source_file_path"),
        rejected_at.alias("rejection_timestamp"),
        F.col("rejection_reasons"),
        F.lit(None).cast("string").alias("validation_details"),
        raw.alias("raw_record"),
    )

