"""Claim validation rules.

Each rule is a Column function that yields its reason string or NULL.  All
rules of a row are gathered in one projection: ``concat_ws`` skips the NULL
reasons, ``split`` turns the joined string back into an array and
``array_remove`` drops the single empty element of a valid row.

Every input column is referenced once per rule: Catalyst pushes the
accepted / quarantined filter below the projections (even into a join
condition), inlining the expressions that produce the inputs, and a
``when(x != '', f(x))`` shape would evaluate ``x`` twice at every nesting
level.  (``array_compact`` is a lambda function, evaluated outside
whole-stage codegen, so it is not used here either.)

A NULL operand never fires a comparison rule (SQL three-valued logic); the
required-field rule is the one that reports missing values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig

# ---- fixed values (reason spellings, field order and code patterns) -------
REQUIRED_FIELDS = [
    "claim_id", "patient_id", "provider_id", "claim_date", "service_from_date",
    "diagnosis_code", "procedure_code", "billed_amount", "claim_status", "claim_type",
]
REQUIRED_FIELD_NULL = "REQUIRED_FIELD_NULL: "
INVALID_BILLED_AMOUNT = "INVALID_BILLED_AMOUNT: Must be > 0 (or = 0 for Denied)"
ALLOWED_OVER_BILLED = "AMOUNT_LOGIC_ERROR: allowed > billed"
PAID_OVER_ALLOWED = "AMOUNT_LOGIC_ERROR: paid > allowed"
FUTURE_CLAIM_DATE = "FUTURE_CLAIM_DATE"
CLAIM_DATE_TOO_OLD = "CLAIM_DATE_TOO_OLD"
SERVICE_TOO_FAR_AFTER_CLAIM = "SERVICE_TOO_FAR_AFTER_CLAIM"
SERVICE_DATE_RANGE_INVALID = "SERVICE_DATE_RANGE_INVALID"
DISCHARGE_BEFORE_ADMISSION = "DISCHARGE_BEFORE_ADMISSION"
INVALID_ICD10_FORMAT = "INVALID_ICD10_FORMAT"
INVALID_CPT_FORMAT = "INVALID_CPT_FORMAT"
APPROVED_WITH_ZERO_PAYMENT = "APPROVED_WITH_ZERO_PAYMENT"
ICD10_PATTERN = r"^[A-Z][0-9]{2}(\.[0-9]{1,3})?$"
CPT_PATTERN = r"^([0-9]{5}|[A-Z][0-9]{4})$"
# ---------------------------------------------------------------------------

REASON_FAMILIES = ("required", "amounts", "dates", "codes", "approved")


def _c(name: str) -> Column:
    return F.col(name)


def rule_required() -> Column:
    """One reason listing every missing required field, in declared order."""
    any_missing = None
    for f in REQUIRED_FIELDS:
        any_missing = _c(f).isNull() if any_missing is None else (any_missing | _c(f).isNull())
    missing = F.concat_ws(", ", *[F.when(_c(f).isNull(), F.lit(f)) for f in REQUIRED_FIELDS])
    return F.when(any_missing, F.concat(F.lit(REQUIRED_FIELD_NULL), missing))


def rules_amounts() -> list[Column]:
    billed, allowed, paid = _c("billed_amount"), _c("allowed_amount"), _c("paid_amount")
    return [
        F.when((billed < 0) | ((billed == 0) & (_c("claim_status") != "Denied")),
               F.lit(INVALID_BILLED_AMOUNT)),
        F.when(allowed > billed, F.lit(ALLOWED_OVER_BILLED)),
        F.when(paid > allowed, F.lit(PAID_OVER_ALLOWED)),
    ]


def rules_dates(cfg: PipelineConfig = DEFAULT) -> list[Column]:
    claim = _c("claim_date")
    sfrom, sto = _c("service_from_date"), _c("service_to_date")
    return [
        F.when(claim > F.lit(cfg.as_of), F.lit(FUTURE_CLAIM_DATE)),
        F.when(claim < F.lit(cfg.min_claim_date), F.lit(CLAIM_DATE_TOO_OLD)),
        F.when(F.datediff(claim, sfrom) < -cfg.late_days, F.lit(SERVICE_TOO_FAR_AFTER_CLAIM)),
        F.when(sto < sfrom, F.lit(SERVICE_DATE_RANGE_INVALID)),
        F.when(_c("discharge_date") < _c("admission_date"), F.lit(DISCHARGE_BEFORE_ADMISSION)),
    ]


def rules_codes() -> list[Column]:
    return [
        F.when(~_c("diagnosis_code").rlike(ICD10_PATTERN), F.lit(INVALID_ICD10_FORMAT)),
        F.when(~_c("procedure_code").rlike(CPT_PATTERN), F.lit(INVALID_CPT_FORMAT)),
    ]


def rules_approved() -> list[Column]:
    paid = _c("paid_amount")
    return [F.when((_c("claim_status") == "Approved") & (paid.isNull() | (paid == 0)),
                   F.lit(APPROVED_WITH_ZERO_PAYMENT))]


def family_rules(family: str, cfg: PipelineConfig = DEFAULT) -> list[Column]:
    return {
        "required": lambda: [rule_required()],
        "amounts": rules_amounts,
        "dates": lambda: rules_dates(cfg),
        "codes": rules_codes,
        "approved": rules_approved,
    }[family]()


# Separator for joining reasons; no reason text contains it.
_SEP = "\u001f"


def rejection_reasons(cfg: PipelineConfig = DEFAULT,
                      families=REASON_FAMILIES) -> Column:
    """All reasons of a row in fixed family order; empty array = valid."""
    rules: list[Column] = []
    for fam in families:
        rules.extend(family_rules(fam, cfg))
    return F.array_remove(F.split(F.concat_ws(_SEP, *rules), _SEP), "")


ALL_REASONS = [
    INVALID_BILLED_AMOUNT, ALLOWED_OVER_BILLED, PAID_OVER_ALLOWED, FUTURE_CLAIM_DATE,
    CLAIM_DATE_TOO_OLD, SERVICE_TOO_FAR_AFTER_CLAIM, SERVICE_DATE_RANGE_INVALID,
    DISCHARGE_BEFORE_ADMISSION, INVALID_ICD10_FORMAT, INVALID_CPT_FORMAT,
    APPROVED_WITH_ZERO_PAYMENT,
]
