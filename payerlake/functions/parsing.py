"""Column functions used at the wire boundary (raw string feed → typed).

Spark 4 runs with ANSI mode on, where a plain ``cast`` of a malformed
value throws.  Every conversion here is the ``try_`` form, so a bad value
becomes NULL and is later reported by the required-field rule instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the original status mapping) -----------------
# Upper-cased raw status  -> canonical status; anything else -> "Under Review".
APPROVED_STATUSES = ["APPROVED", "PAID", "PROCESSED"]
DENIED_STATUSES = ["DENIED", "REJECTED"]
PENDING_STATUSES = ["PENDING", "PROCESSING"]
REVIEW_STATUS = "Under Review"
# ---------------------------------------------------------------------------

AMOUNT_TYPE = "decimal(10,2)"


def parse_currency(c: Column | str) -> Column:
    """'$1,234.50' / '1234.50' → decimal(10,2); junk or overflow → NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(c, "$,", "").try_cast(AMOUNT_TYPE)


def parse_amount(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(AMOUNT_TYPE)


def parse_date(c: Column | str, fmt: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(c, fmt)


def standardize_status(c: Column | str, null_as_review: bool = False) -> Column:
    """Case-insensitive status normaliser (no trimming, like the original).

    A NULL raw status stays NULL unless ``null_as_review`` is set, so that
    the required-field rule can see it.
    """
    c = F.col(c) if isinstance(c, str) else c
    u = F.upper(c)
    out = (F.when(u.isin(APPROVED_STATUSES), "Approved")
            .when(u.isin(DENIED_STATUSES), "Denied")
            .when(u.isin(PENDING_STATUSES), "Pending"))
    if null_as_review:
        return out.otherwise(REVIEW_STATUS)
    return out.when(c.isNotNull(), REVIEW_STATUS)


def clean_diagnosis(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(c))


def clean_procedure(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c)


def format_currency(c: Column | str) -> Column:
    """decimal → '$1,234.50' (the wire format of feed B)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("$"), F.format_number(c, 2))
