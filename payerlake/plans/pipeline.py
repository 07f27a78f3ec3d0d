"""End-to-end driver: bronze → silver → gate → gold → reconcile.

A plain ordered sequence of set-based jobs (the original's scheduler DAG,
retries and UI are orchestration, not data operators).  Every step is
idempotent, so re-running the pipeline after any failure is safe.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from ..config import DEFAULT, PipelineConfig
from ..operators import incremental, quality
from ..sources.lake import Lake, read_quarantine, read_silver
from . import bronze, gold, silver


def run_pipeline(spark: SparkSession, lake: Lake, run_id: str, run_ts: _dt.datetime,
                 cfg: PipelineConfig = DEFAULT, enforce_gate: bool = False,
                 strict_reconcile: bool = False) -> dict:
    registered = bronze.register_new_files(spark, lake, run_ts).count()
    s = silver.run_silver(spark, lake, run_id, run_ts, cfg)
    gate = quality.quarantine_gate(read_silver(spark, lake), read_quarantine(spark, lake), cfg)
    gate_row = quality.enforce(gate) if enforce_gate else gate.first().asDict()
    report = gold.run_gold(spark, lake, run_ts, cfg)
    if strict_reconcile:
        incremental.enforce_reconciliation(report)
    return {"registered": registered, "silver": s, "gate": gate_row}
