"""Per-rule hand rows, including NULL operands and boundaries."""

import datetime as dt
from decimal import Decimal

import pytest

from payerlake.config import PipelineConfig
from payerlake.functions import rules as R
from payerlake.operators import validate
from payerlake.schemas import CLAIM_FIELDS

from pyspark.sql import types as T

CFG = PipelineConfig(as_of=dt.date(2024, 6, 30), min_claim_date=dt.date(2020, 1, 1))
SCHEMA = T.StructType(CLAIM_FIELDS)


def good(**over):
    row = dict(claim_id="c1", patient_id="PAT1", provider_id="100", claim_date=dt.date(2024, 3, 1),
               service_from_date=dt.date(2024, 2, 20), service_to_date=dt.date(2024, 2, 22),
               admission_date=None, discharge_date=None, diagnosis_code="E11.9", procedure_code="99213",
               billed_amount=Decimal("100.00"), allowed_amount=Decimal("80.00"),
               paid_amount=Decimal("76.00"), claim_status="Approved", claim_type="Outpatient",
               payer_name="payer_a")
    row.update(over)
    return row


def reasons(spark, *rows):
    df = spark.createDataFrame([tuple(r[f.name] for f in SCHEMA.fields) for r in rows], SCHEMA)
    return [r.rejection_reasons for r in validate.with_reasons(df, CFG).collect()]


def test_clean_row_has_no_reason(spark):
    assert reasons(spark, good()) == [[]]


def test_all_required_null_gives_one_reason_in_order(spark):
    row = good(**{f: None for f in R.REQUIRED_FIELDS})
    (r,), = [reasons(spark, row)]
    assert r[0] == R.REQUIRED_FIELD_NULL + ", ".join(R.REQUIRED_FIELDS)
    # NULL operands never fire any comparison rule
    assert r == [r[0]]


def test_claim_date_boundaries(spark):
    out = reasons(spark, good(claim_date=CFG.as_of, service_from_date=CFG.as_of, service_to_date=CFG.as_of),
                  good(claim_date=CFG.as_of + dt.timedelta(days=1), service_from_date=CFG.as_of,
                       service_to_date=CFG.as_of),
                  good(claim_date=dt.date(2019, 12, 31), service_from_date=dt.date(2019, 12, 31),
                       service_to_date=dt.date(2019, 12, 31)))
    assert out == [[], [R.FUTURE_CLAIM_DATE], [R.CLAIM_DATE_TOO_OLD]]


def test_service_after_claim_window(spark):
    c = dt.date(2024, 3, 1)
    out = reasons(spark,
                  good(claim_date=c, service_from_date=c + dt.timedelta(days=60), service_to_date=None),
                  good(claim_date=c, service_from_date=c + dt.timedelta(days=61), service_to_date=None))
    assert out == [[], [R.SERVICE_TOO_FAR_AFTER_CLAIM]]


def test_service_range_and_discharge(spark):
    d = dt.date(2024, 2, 20)
    out = reasons(spark, good(service_from_date=d, service_to_date=d),
                  good(service_from_date=d, service_to_date=d - dt.timedelta(days=1)),
                  good(admission_date=d, discharge_date=d - dt.timedelta(days=1)),
                  good(admission_date=d, discharge_date=None))
    assert out == [[], [R.SERVICE_DATE_RANGE_INVALID], [R.DISCHARGE_BEFORE_ADMISSION], []]


def test_amount_rules(spark):
    z = Decimal("0.00")
    out = reasons(spark,
                  good(billed_amount=z, allowed_amount=z, paid_amount=z, claim_status="Denied"),
                  good(billed_amount=z, allowed_amount=z, paid_amount=Decimal("1.00"), claim_status="Pending"),
                  good(billed_amount=Decimal("-5.00"), allowed_amount=None, paid_amount=None,
                       claim_status="Denied"),
                  good(allowed_amount=Decimal("100.01")),
                  good(paid_amount=Decimal("80.00")),
                  good(paid_amount=Decimal("80.01")))
    assert out[0] == []
    assert out[1] == [R.INVALID_BILLED_AMOUNT, R.PAID_OVER_ALLOWED]
    assert out[2] == [R.INVALID_BILLED_AMOUNT]
    assert out[3] == [R.ALLOWED_OVER_BILLED]
    assert out[4] == []
    assert out[5] == [R.PAID_OVER_ALLOWED]


def test_approved_zero_payment_and_family_order(spark):
    out = reasons(spark, good(paid_amount=Decimal("0.00")), good(paid_amount=None),
                  good(billed_amount=Decimal("0.00"), allowed_amount=Decimal("0.00"),
                       paid_amount=Decimal("0.00"), diagnosis_code="e11"))
    assert out[0] == [R.APPROVED_WITH_ZERO_PAYMENT]
    assert out[1] == [R.APPROVED_WITH_ZERO_PAYMENT]
    # amounts before codes before approved
    assert out[2] == [R.INVALID_BILLED_AMOUNT, R.INVALID_ICD10_FORMAT, R.APPROVED_WITH_ZERO_PAYMENT]


@pytest.mark.parametrize("code,ok", [("E11", True), ("E11.9", True), ("E11.123", True), ("E11.1234", False),
                                     ("E1", False), ("11.9", False), ("e11.9", False)])
def test_icd10_pattern(spark, code, ok):
    (r,) = reasons(spark, good(diagnosis_code=code))
    assert (r == []) == ok


@pytest.mark.parametrize("code,ok", [("99213", True), ("G0438", True), ("12", False), ("9921", False),
                                     ("G043", False), ("992134", False)])
def test_cpt_pattern(spark, code, ok):
    (r,) = reasons(spark, good(procedure_code=code))
    assert (r == []) == ok


def test_null_codes_only_report_required(spark):
    (r,) = reasons(spark, good(diagnosis_code=None, procedure_code=None))
    assert r == [R.REQUIRED_FIELD_NULL + "diagnosis_code, procedure_code"]


def test_split_is_a_partition(spark):
    rows = [good(claim_id=f"c{i}", paid_amount=Decimal("0.00") if i % 3 == 0 else Decimal("76.00"))
            for i in range(30)]
    df = spark.createDataFrame([tuple(r[f.name] for f in SCHEMA.fields) for r in rows], SCHEMA)
    ok, bad = validate.split(df, CFG)
    assert ok.count() + bad.count() == 30
    assert bad.count() == 10
    assert {r for (r,) in bad.select("rejection_reasons").collect() for r in r} <= set(R.ALL_REASONS)
