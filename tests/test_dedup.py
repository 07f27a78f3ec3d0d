"""Duplicate claims: within a run, across runs, through the filter of published keys."""

import dataclasses

import pytest
from pyspark.sql import functions as F
from test_files import TS1, TS2, claim_row, write_file

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import dedup, standardize as S
from payerlake.plans import bronze, keys, silver
from payerlake.sources.lake import read_quarantine, read_silver

COLS = S.wire_columns("payer_c")
DEDUP = dataclasses.replace(DEFAULT, dedup=True)


def deliver(spark, lake, name, run, ids, cfg=DEDUP, ts=TS1, **changes):
    write_file(lake, f"{name}.csv", COLS, [claim_row(CLAIM_ID=i, **changes) for i in ids])
    bronze.register_new_files(spark, lake, ts)
    return silver.run_silver(spark, lake, run, ts, cfg)


def published(spark, lake):
    return sorted(r.claim_id for r in read_silver(spark, lake).collect())


def duplicates(spark, lake):
    return sorted(r.claim_id for r in read_quarantine(spark, lake).collect()
                  if r.rejection_reasons == [f"{dedup.REASON}: claim_id"])


def test_duplicates_across_runs_go_to_quarantine(spark, lake, monkeypatch):
    monkeypatch.setattr(keys, "MOST_PARTS", 1)
    deliver(spark, lake, "a", "run-1", ["a", "b"], DEFAULT)  # published without dedup
    deliver(spark, lake, "b", "run-2", ["a", "c", "c"])
    assert published(spark, lake) == ["a", "b", "c"] and duplicates(spark, lake) == ["a", "c"]
    out = deliver(spark, lake, "c", "run-3", ["c", "d"], ts=TS2)
    assert out["error"] is None
    assert published(spark, lake) == ["a", "b", "c", "d"] and duplicates(spark, lake) == ["a", "c", "c"]


def test_filter_rules_out_and_never_misses(spark):
    old = spark.range(3000).select(F.lit("payer_a").alias("payer_name"), F.col("id").cast("string").alias("claim_id"))
    other = old.withColumn("payer_name", F.lit("payer_b"))
    parts = dedup.key_filter(old.filter("claim_id % 2 = 0"), 8).unionByName(dedup.key_filter(old.filter("claim_id % 2 = 1"), 8))
    filters = dedup.merged(parts)
    assert dedup.maybe_published(old, filters, 8).count() == 3000
    assert dedup.maybe_published(other, filters, 8).count() < 150
    assert filters.count() == 8 and dedup.maybe_published(old, filters.limit(0), 8).count() == 0


@pytest.mark.parametrize("known", [[], ["x"]])
def test_the_newest_row_of_a_key_stays(spark, known):
    rows = [("p", "x", 1, 1), ("p", "x", 2, 3), ("p", "x", 3, 3), ("p", "y", 4, 1), (None, "z", 5, 1), (None, "z", 6, 1)]
    df = spark.createDataFrame(rows, "payer_name string, claim_id string, row_id int, newest int")
    old = spark.createDataFrame([("p", k) for k in known], "payer_name string, claim_id string")
    got = sorted(r.row_id for r in dedup.duplicate_rows(df, old).collect())
    assert [i for i in got if i < 5] == ([1, 2, 3] if known else [1, 2])
