"""Command-line driver for the jobs (one step or the whole pipeline).

    spark-submit payerlake/cli.py --root <lake folder> pipeline
    python -m payerlake.cli --root <lake folder> bronze|silver|stream|gold|gate|report|verify|tables|compact|vacuum
    python -m payerlake.cli --root <lake folder> --confirm drop

``report`` writes every summary report of the lake as JSON lines below
``<root>/reports/<name>`` and prints their row counts.  A step whose files
failed, or whose gate is not passed, exits with 1.

The lake root must be on the shared filesystem of the cluster; raw payer
files are expected under ``<root>/raw/provider=<payer>/year=YYYY/month=M/...``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import uuid

from .config import DEFAULT, PipelineConfig
from .operators import incremental, quality
from .plans import bronze, compact, gold, pipeline, reporting, silver
from .session import build_session
from .sources import files as FS
from .sources import lake as L


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="payerlake")
    ap.add_argument("--root", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--lookback-days", type=int, default=365)
    ap.add_argument("--threshold", type=float, default=DEFAULT.quarantine_threshold_pct)
    ap.add_argument("--min-claim-date", default=DEFAULT.min_claim_date.isoformat())
    ap.add_argument("--late-days", type=int, default=DEFAULT.late_days)
    ap.add_argument("--top-codes", type=int, default=DEFAULT.top_codes)
    ap.add_argument("--null-status-as-review", action="store_true")
    ap.add_argument("--dedup", action="store_true", help="quarantine claims that are published already")
    ap.add_argument("--max-files", type=int, default=1000, help="files of one micro-batch")
    ap.add_argument("--listing-overlap-hours", type=float, default=None,
                    help="bronze: list only files written since the last registration less these hours")
    ap.add_argument("--target-mb", type=int, default=128, help="compact: size of a rewritten file")
    ap.add_argument("--keep-hours", type=float, default=24, help="vacuum: keep what was replaced within these hours")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--confirm", action="store_true")
    ap.add_argument("step", choices=["pipeline", "bronze", "silver", "stream", "gold", "gate", "report",
                                     "verify", "tables", "compact", "vacuum", "drop"])
    a = ap.parse_args(argv)
    cfg = PipelineConfig(as_of=dt.date.fromisoformat(a.as_of), lookback_days=a.lookback_days,
                         quarantine_threshold_pct=a.threshold, top_codes=a.top_codes, late_days=a.late_days,
                         min_claim_date=dt.date.fromisoformat(a.min_claim_date),
                         null_status_as_review=a.null_status_as_review, dedup=a.dedup)
    spark = build_session(a.master)
    lake = L.Lake(a.root.rstrip("/"))
    now = dt.datetime.now().replace(microsecond=0)
    run_id = a.run_id or f"run-{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}"
    code = 0
    if a.step == "pipeline":
        out = pipeline.run_pipeline(spark, lake, run_id, now, cfg, enforce_gate=True)
        print(json.dumps(out, default=str))
        code = int(out["silver"]["failed"] > 0)
    elif a.step == "bronze":
        since = None if a.listing_overlap_hours is None else bronze.listing_start(
            spark, lake, dt.timedelta(hours=a.listing_overlap_hours))
        listing = FS.list_files(spark, lake.raw, since)
        print(bronze.register_new_files(spark, lake, now, listing).count(), "files registered")
    elif a.step == "silver":
        out = silver.run_silver(spark, lake, run_id, now, cfg)
        print(json.dumps(out, default=str))
        code = int(out["failed"] > 0)
    elif a.step == "stream":
        from .streaming.ingest import run_ingest
        run_ingest(spark, lake, None, cfg, a.max_files)
        print("landing folder consumed")
    elif a.step == "report":
        print(json.dumps(reporting.write_reports(spark, lake, cfg)))
    elif a.step == "gold":
        report = gold.run_gold(spark, lake, now, cfg)
        incremental.enforce_reconciliation(report)
        print("gold refreshed; reconciliation passed")
    elif a.step == "gate":
        g = quality.quarantine_gate(L.read_silver(spark, lake), L.read_quarantine(spark, lake), cfg).first()
        print(json.dumps(g.asDict(), default=str))
        code = 0 if g.passed else 1
    elif a.step == "verify":
        L.list_tables(spark, lake).show(truncate=False)
        L.table_counts(spark, lake).show(truncate=False)
    elif a.step == "tables":
        print(L.ensure_tables(spark, lake))
    elif a.step == "compact":
        print(json.dumps(compact.compact(spark, lake, a.run_id or f"compact-{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}", now,
                                         a.target_mb * 1024 * 1024)))
    elif a.step == "vacuum":
        print(compact.vacuum(spark, lake, now - dt.timedelta(hours=a.keep_hours)), "replaced partitions deleted")
    elif a.step == "drop":
        print(L.drop_tables(spark, lake, confirm=a.confirm))
    spark.stop()
    return code


if __name__ == "__main__":
    sys.exit(main())
