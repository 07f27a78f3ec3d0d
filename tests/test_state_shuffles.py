"""What the gold refresh and the quarantine shuffle: each row once, and no wide sums a provider."""

import re
from decimal import Decimal

from test_files import TS1, claim_row, write_file

from payerlake.config import FIXTURE
from payerlake.operators import gold_state, standardize as S, upsert
from payerlake.plans import bronze, silver
from payerlake.sources.lake import read_quarantine

SILVER = ("year_month string, payer_name string, claim_type string, provider_id string, patient_id string, claim_status string, "
          "diagnosis_code string, procedure_code string, claim_date date, processing_date date, billed_amount decimal(10,2), "
          "allowed_amount decimal(10,2), paid_amount decimal(10,2)")


def claims(spark, rows):
    """Claims of (payer, provider, patient, status, billed, paid) in one month."""
    return spark.createDataFrame([("2001-01", payer, "Inpatient", provider, patient, status, "A01", "90000", None, None,
                                   billed and Decimal(billed), None, paid and Decimal(paid))
                                  for payer, provider, patient, status, billed, paid in rows], SILVER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_patients_are_dealt_once(spark):
    got = gold_state.patients(claims(spark, [("payer_a", "1", "p", "Denied", "1", "0")]))
    assert re.findall(r"Exchange (\w+)\(year_month#\d+, slice", plan(got)) == ["hashpartitioning"] and plan(got).count("Exchange ") == 1


def test_sums_of_a_month_are_not_dealt_by_provider(spark):
    state = claims(spark, [("payer_a", "1", "p", "Denied", "1", "0")])
    text = plan(gold_state.monthly_summary(gold_state.measures(state), gold_state.patients(state)))
    sums = [line for line in text.splitlines() if "keys=[year_month" in line and "sum(claims#" in line]
    assert sums and not any("provider_id" in line.split("functions=")[0] for line in sums)


def test_sums_in_cents(spark):
    rows = [("payer_a", "1", "p", "Approved", "99999999.99", "0.01"), ("payer_a", "1", "q", "Approved", None, "-0.29"),
            ("payer_a", "1", "q", "Denied", "0.29", None), ("payer_a", "2", "q", "Denied", None, None)]
    got = {r.provider_id: r for r in gold_state.measures(claims(spark, rows)).collect()}
    one, two = got["1"], got["2"]
    assert (one.billed, one.paid, one.write_off) == (Decimal("100000000.28"), Decimal("-0.28"), Decimal("100000000.27"))
    assert (one.billed_approved, one.billed_denied, one.n_billed, one.n_paid) == (Decimal("99999999.99"), Decimal("0.29"), 2, 2)
    assert (two.billed, two.paid, two.write_off, two.billed_approved, two.billed_denied) == (None, None, None, Decimal(0), None)
    # Hash maps of whole numbers.
    assert "sum(cast((billed_amount" in plan(gold_state.measures(claims(spark, rows))).replace("partial_", "")


def test_null_payers_keep_their_providers(spark):
    state = claims(spark, [(None, "1", "p", "Denied", "1", "0"), (None, "2", "p", "Denied", "1", "0"), ("payer_a", None, "p", "Denied", "1", "0")])
    got = {r.payer_name: (r.total_claims, r.unique_providers)
           for r in gold_state.monthly_summary(gold_state.measures(state), gold_state.patients(state)).collect()}
    assert got == {None: (2, 2), "payer_a": (1, 0)}


def test_quarantine_is_written_without_a_shuffle(spark, lake, monkeypatch):
    cols, written, real = S.wire_columns("payer_c"), {}, upsert.overwrite_partitions

    def watched(df, path, parts, *a, **k):
        written[path] = k.get("cluster", True)
        real(df, path, parts, *a, **k)
    monkeypatch.setattr(upsert, "overwrite_partitions", watched)
    write_file(lake, "a.csv", cols, [claim_row(CLAIM_ID="good"), claim_row(CLAIM_ID="bad", PROC_CD="x")])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-1", TS1, FIXTURE)
    assert written[lake.quarantine] is False and written[lake.silver_claims] is True
    assert [r.claim_id for r in read_quarantine(spark, lake).collect()] == ["bad"]
