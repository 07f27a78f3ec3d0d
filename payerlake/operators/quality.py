"""Quality gate: fail the run when too many claims are quarantined.

The gate is a one-row DataFrame (accepted, quarantined, rate, passed) so it
can be stored or reported like any other result; ``enforce`` turns a
failed gate into an exception for the orchestrating driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import metrics as M
from .reports import quality_counts


class QualityGateFailed(RuntimeError):
    pass


def quarantine_gate(silver: DataFrame, quarantine: DataFrame,
                    cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Passes when quarantined / total <= threshold percent; an empty input passes.

    The comparison is exact: quarantined * 100 > threshold * total.
    """
    thr = F.lit(str(cfg.quarantine_threshold_pct)).cast("decimal(9,4)")
    c = quality_counts(silver, quarantine)
    total = F.col("accepted") + F.col("quarantined")
    return c.select(
        "accepted", "quarantined",
        M.pct(F.col("quarantined"), total).alias("quarantine_rate"),
        thr.cast(M.RATE_T).alias("threshold"),
        ((total == 0) | ~(F.col("quarantined") * 100 > thr * total)).alias("passed"))


def enforce(gate: DataFrame) -> dict:
    """Collect the single gate row and raise when it failed."""
    row = gate.first().asDict()
    if not row["passed"]:
        raise QualityGateFailed(
            f"quarantine rate {row['quarantine_rate']}% exceeds {row['threshold']}%")
    return row
