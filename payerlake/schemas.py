"""Fixed table schemas (the table contracts of every layer)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, L, I = T.StringType(), T.DateType(), T.TimestampType(), T.LongType(), T.IntegerType()
AMT = T.DecimalType(10, 2)


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


FILE_REGISTRY = T.StructType([
    _f("file_path", S, False), _f("file_name", S, False), _f("payer_name", S),
    _f("file_year", I), _f("file_month", I), _f("file_size_bytes", L), _f("record_count", L),
    _f("schema_version", S), _f("ingestion_timestamp", TS, False), _f("processing_status", S, False),
    # The column names of the file's first line, in its order; NULL without a line.
    _f("header_columns", T.ArrayType(S)),
])

CLAIM_FIELDS = [
    _f("claim_id", S), _f("patient_id", S), _f("provider_id", S), _f("claim_date", D),
    _f("service_from_date", D), _f("service_to_date", D), _f("admission_date", D),
    _f("discharge_date", D), _f("diagnosis_code", S), _f("procedure_code", S),
    _f("billed_amount", AMT), _f("allowed_amount", AMT), _f("paid_amount", AMT),
    _f("claim_status", S), _f("claim_type", S), _f("payer_name", S),
]

SILVER_CLAIMS = T.StructType(CLAIM_FIELDS + [
    _f("source_file_path", S), _f("ingestion_timestamp", TS), _f("processing_date", D),
    _f("run_id", S), _f("claim_month", S),
])

QUARANTINE = T.StructType(
    [_f(c.name, S) for c in CLAIM_FIELDS if c.name != "payer_name"] + [
        _f("payer_name", S), _f("source_file_path", S), _f("rejection_timestamp", TS),
        _f("rejection_reasons", T.ArrayType(S)), _f("validation_details", S), _f("raw_record", S),
        _f("run_id", S), _f("rejection_day", S),
    ])

PROCESSING_LOG = T.StructType([
    _f("processing_id", S, False), _f("bronze_file_path", S, False), _f("payer_name", S),
    _f("event_timestamp", TS, False), _f("status", S, False), _f("records_read", L),
    _f("records_accepted", L), _f("records_quarantined", L), _f("error_message", S),
    # The day the run's claims are dated with (their processing_date).
    _f("processing_date", D), _f("run_id", S, False),
])

COMPACTIONS = T.StructType([
    _f("compaction_id", S, False), _f("claim_month", S, False), _f("run_id", S, False),
    _f("processing_date", D), _f("event_timestamp", TS, False),
])

LOG_STATUS_RANK = {"running": 0, "failed": 1, "completed": 2}
