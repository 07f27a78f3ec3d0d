"""Typed run parameters shared by every job.

Every clock-dependent rule takes its "today" from ``as_of`` so that the
same input always produces the same output (the original jobs read the
wall clock; we make it an explicit parameter).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    # Date treated as "today" by FUTURE_CLAIM_DATE and by the look-back window.
    as_of: _dt.date = field(default_factory=_dt.date.today)
    # Claims older than this are rejected (CLAIM_DATE_TOO_OLD).
    min_claim_date: _dt.date = _dt.date(2020, 1, 1)
    # A service date may lie at most this many days after the claim date.
    late_days: int = 60
    # Gold refresh: recompute slices touched by rows processed in the last n days.
    lookback_days: int = 365
    # Quality gate: fail when the quarantine share (percent) exceeds this.
    quarantine_threshold_pct: float = 10.0
    # Number of most frequent codes kept per provider.
    top_codes: int = 5
    # The original mapping turned a missing status into "Under Review"; by
    # default we keep NULL so that the required-field rule can fire.
    null_status_as_review: bool = False
    # Send claims whose (payer, claim id) is already published, or twice in a run, to quarantine.
    dedup: bool = False
    # Bitmaps (4 KB each) of the filter of published keys; about 3,000 keys a bitmap keep it sharp.
    dedup_buckets: int = 4096
    # Fixture writer: batch folders per payer and month (the writer's
    # rebalance already splits an oversized payer-month by size).
    files_per_month: int = 1
    # Salt for patient-id masking.
    mask_salt: str = "payerlake"
    # Top-k size for retrieval and ranking reports.
    retrieval_k: int = 5


DEFAULT = PipelineConfig()

# The given tables hold orders of 1992 to 1998: their queries, tests and bench run as of this day.
FIXTURE = PipelineConfig(as_of=_dt.date(2001, 6, 30), min_claim_date=_dt.date(1996, 1, 1))
