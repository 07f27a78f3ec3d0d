"""Quarantine gate edges: exactly 10.0 passes, 10.01 fails, no rows passes."""

import pytest

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import quality


def frames(spark, ok, bad):
    return spark.range(ok).toDF("x"), spark.range(bad).toDF("x")


@pytest.mark.parametrize("ok,bad,passed", [(9000, 1000, True), (8999, 1001, False), (0, 0, True),
                                           (1, 0, True), (0, 1, False)])
def test_gate(spark, ok, bad, passed):
    g = quality.quarantine_gate(*frames(spark, ok, bad), DEFAULT).first()
    assert g.passed is passed
    assert g.accepted == ok and g.quarantined == bad


def test_enforce_raises(spark):
    with pytest.raises(quality.QualityGateFailed):
        quality.enforce(quality.quarantine_gate(*frames(spark, 1, 1), DEFAULT))
    assert quality.enforce(quality.quarantine_gate(*frames(spark, 9, 1), DEFAULT))["passed"]
