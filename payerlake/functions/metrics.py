"""Aggregate expressions shared by the gold tables and reports.

Result types are fixed here (they are part of the table contract), so every
caller gets the same decimal precision and scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_T = "decimal(18,2)"
AVG_T = "decimal(10,2)"
RATE_T = "decimal(5,2)"
DAYS_T = "decimal(7,1)"

APPROVED = "Approved"
DENIED = "Denied"
PENDING_LIKE = ["Pending", "Under Review"]


def is_approved() -> Column:
    return F.col("claim_status") == APPROVED


def is_denied() -> Column:
    return F.col("claim_status") == DENIED


def is_pending() -> Column:
    return F.col("claim_status").isin(PENDING_LIKE)


def dsum(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast(SUM_T)


def avg2(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.avg(c), 2).cast(AVG_T)


def pct(part: Column, whole: Column) -> Column:
    """round(part * 100.0 / whole, 2) as decimal(5,2); NULL when whole is 0."""
    return F.round(part * F.lit(100.0).cast("decimal(4,1)") / F.nullif(whole, F.lit(0)), 2).cast(RATE_T)


def rate_of(cond: Column) -> Column:
    return pct(F.count_if(cond), F.count(F.lit(1)))


def reimbursement_ratio(only_approved: bool) -> Column:
    """Per-row paid/billed in percent.

    Monthly summary: rows with billed <= 0 count as 0.  Funnel: only approved
    rows with billed > 0 take part, the rest are NULL (ignored by avg).
    """
    billed, paid = F.col("billed_amount"), F.col("paid_amount")
    # Most claims that are not approved are paid nothing: no wide division for them.
    ratio = F.when(paid == 0, F.lit(0)).otherwise(paid / billed * 100)
    if only_approved:
        return F.when(is_approved() & (billed > 0), ratio)
    return F.when(billed > 0, ratio).otherwise(F.lit(0))


def year_month(c: Column | str = "claim_date") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM")
