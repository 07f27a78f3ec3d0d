"""Payer feed layouts ⇄ the canonical claim schema.

Each payer layout is one mapping table (canonical column, wire column,
converter).  Parsing a feed is a single ``select`` generated from that
table; rendering canonical claims back to the wire format (used to build
test feeds) is the inverse ``select``.  Nothing here loops over rows or
files, and every converter is a built-in Column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import parsing as P

# ---- fixed values: payer wire layouts (column names and formats) ----------
# canonical column -> (feed A column, feed B column, feed C column)
FEED_COLUMNS = {
    "claim_id": ("ClaimID", "claim_number", "CLAIM_ID"),
    "patient_id": ("MemberID", "patient_id", "SUBSCRIBER_ID"),
    "provider_id": ("ProviderNPI", "provider_tax_id", "RENDERING_PROVIDER_NPI"),
    "claim_date": ("ClaimDate", "claim_received_date", "RECEIVED_DT"),
    "service_from_date": ("ServiceFromDate", "service_date", "SVC_FROM_DT"),
    "service_to_date": ("ServiceToDate", "service_date", "SVC_TO_DT"),
    "admission_date": (None, "admit_date", None),
    "discharge_date": (None, "discharge_date", None),
    "diagnosis_code": ("DiagnosisCode", "primary_diagnosis", "DIAG_CD"),
    "procedure_code": ("ProcedureCode", "procedure", "PROC_CD"),
    "billed_amount": ("BilledAmount", "charge_amount", "BILLED_AMT"),
    "allowed_amount": ("AllowedAmount", "approved_amount", "ALLOWED_AMT"),
    "paid_amount": ("PaidAmount", "payment_amount", "PAID_AMT"),
    "claim_status": ("Status", "claim_status", "CLM_STATUS"),
    "claim_type": ("Type", "service_category", "CLM_TYPE"),
}
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd")
CURRENCY_SYMBOLS = (False, True, False)
# ---------------------------------------------------------------------------

PAYERS = ("payer_a", "payer_b", "payer_c")
DATE_COLS = ["claim_date", "service_from_date", "service_to_date", "admission_date", "discharge_date"]
AMOUNT_COLS = ["billed_amount", "allowed_amount", "paid_amount"]
CANONICAL = list(FEED_COLUMNS)

# How each test feed spells a canonical status (any spelling the normaliser
# accepts); feeds differ so the normaliser sees several vocabularies.
STATUS_SPELLING = {
    "payer_a": {"Approved": "Approved", "Denied": "Denied", "Pending": "Pending", "Under Review": "Under Review"},
    "payer_b": {"Approved": "approved", "Denied": "denied", "Pending": "pending", "Under Review": "in review"},
    "payer_c": {"Approved": "PAID", "Denied": "REJECTED", "Pending": "PROCESSING", "Under Review": "REVIEW"},
}


def layout(payer: str) -> dict[str, str | None]:
    i = PAYERS.index(payer)
    return {canon: cols[i] for canon, cols in FEED_COLUMNS.items()}


def wire_columns(payer: str) -> list[str]:
    """Distinct wire columns of a payer in layout order (the CSV header)."""
    seen: list[str] = []
    for col in layout(payer).values():
        if col and col not in seen:
            seen.append(col)
    return seen


def known_payer(payer: str) -> bool:
    return payer in PAYERS


def to_canonical(raw: DataFrame, payer: str, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Parse one payer's string feed into canonical columns (+ payer_name)."""
    i = PAYERS.index(payer)
    fmt, currency = DATE_FORMATS[i], CURRENCY_SYMBOLS[i]
    out: list[Column] = []
    for canon, src in layout(payer).items():
        if src is None:
            expr = F.lit(None)
        else:
            c = F.col(src)
            if canon in DATE_COLS:
                expr = P.parse_date(c, fmt)
            elif canon in AMOUNT_COLS:
                expr = P.parse_currency(c) if currency else P.parse_amount(c)
            elif canon == "diagnosis_code":
                expr = P.clean_diagnosis(c)
            elif canon == "procedure_code":
                expr = P.clean_procedure(c)
            elif canon == "claim_status":
                expr = P.standardize_status(c, cfg.null_status_as_review)
            else:
                expr = c
        if canon in DATE_COLS:
            expr = expr.cast("date")
        elif canon in AMOUNT_COLS:
            expr = expr.cast(P.AMOUNT_TYPE)
        else:
            expr = expr.cast("string")
        out.append(expr.alias(canon))
    keep = [c for c in raw.columns if c not in set(wire_columns(payer))]
    return raw.select(*out, F.lit(payer).alias("payer_name"), *keep)


def render_feed(claims: DataFrame, payer: str, keep: list[str] | None = None) -> DataFrame:
    """Canonical claims of one payer → that payer's all-string wire layout.

    The test feeds also exercise the cleaning steps: feed B writes the
    diagnosis in lower case with a trailing blank and the procedure with a
    leading blank; feed C writes upper-case status words.
    """
    i = PAYERS.index(payer)
    fmt, currency = DATE_FORMATS[i], CURRENCY_SYMBOLS[i]
    spell = STATUS_SPELLING[payer]
    status = None
    for canon, raw in spell.items():
        cond = F.col("claim_status") == canon
        status = F.when(cond, raw) if status is None else status.when(cond, raw)
    status = status.otherwise(F.col("claim_status"))
    cols: dict[str, Column] = {}
    for canon, src in layout(payer).items():
        if src is None or src in cols:
            continue
        c = F.col(canon)
        if canon in DATE_COLS:
            expr = F.date_format(c, fmt)
        elif canon in AMOUNT_COLS:
            expr = P.format_currency(c) if currency else c.cast("string")
        elif canon == "claim_status":
            expr = status
        elif canon == "diagnosis_code" and payer == "payer_b":
            expr = F.concat(F.lower(c), F.lit(" "))
        elif canon == "procedure_code" and payer == "payer_b":
            expr = F.concat(F.lit(" "), c)
        else:
            expr = c.cast("string")
        cols[src] = expr.alias(src)
    return claims.filter(F.col("payer_name") == payer).select(*cols.values(), *(keep or []))


def standardize_all(feeds: dict[str, DataFrame], cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Map every known payer's feed and union by name (one plan, no loop of jobs)."""
    parts = [to_canonical(df, p, cfg) for p, df in feeds.items() if known_payer(p)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
