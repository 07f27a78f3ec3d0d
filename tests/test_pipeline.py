"""The end-to-end driver: bronze → silver → gate → gold → reconcile."""

import dataclasses
import datetime as dt

import pytest

from payerlake.config import FIXTURE
from payerlake.operators import quality
from payerlake.plans import pipeline
from payerlake.sources import files as FS
from payerlake.sources.claims_fixture import claims_table

from conftest import SF_SMALL


def test_pipeline_gate_and_reconcile(spark, lake):
    cfg = FIXTURE
    FS.write_feeds(claims_table(spark, SF_SMALL), lake.raw, cfg)
    ts = dt.datetime(2001, 6, 30, 3)
    out = pipeline.run_pipeline(spark, lake, "run-p", ts, cfg, strict_reconcile=True)
    assert out["registered"] > 0
    g = out["gate"]
    assert g["accepted"] + g["quarantined"] == claims_table(spark, SF_SMALL).count()
    # the fixture quarantines far more than 10 %: an enforced gate fails the run
    assert g["passed"] is False
    with pytest.raises(quality.QualityGateFailed):
        pipeline.run_pipeline(spark, lake, "run-q", ts, cfg, enforce_gate=True)
    # a lenient threshold passes
    lenient = dataclasses.replace(FIXTURE, quarantine_threshold_pct=50.0)
    assert pipeline.run_pipeline(spark, lake, "run-r", ts, lenient)["gate"]["passed"] is True
