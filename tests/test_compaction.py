"""Compaction: packing, both states of a reader, crash before the commit, gold afterwards."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_files import TS1, TS2, claim_row, write_file

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import standardize as S
from payerlake.plans import bronze, compact, gold, silver
from payerlake.session import local_path
from payerlake.sources.lake import read_compactions, read_silver

COLS = S.wire_columns("payer_c")


def deliver(spark, lake, n, start=0):
    for i in range(start, start + n):
        day = f"2001{3 + i % 2:02d}01"
        write_file(lake, f"{i}.csv", COLS, [claim_row(CLAIM_ID=f"c{i}", RECEIVED_DT=day, SVC_FROM_DT=day, SVC_TO_DT=day)])
        bronze.register_new_files(spark, lake, TS1)
        silver.run_silver(spark, lake, f"run-{i}", TS1, DEFAULT)


def rows(spark, lake):
    return sorted(map(str, read_silver(spark, lake).drop("run_id").collect()))


def data_files(df):
    return len({f for f in df.inputFiles()})


def test_many_small_runs_become_a_few_files(spark, lake):
    deliver(spark, lake, 8)
    before, state = rows(spark, lake), read_silver(spark, lake)
    out = compact.compact(spark, lake, "compact-1", TS2)
    assert out == {"run_id": "compact-1", "partitions": 8, "rows": 8}
    assert rows(spark, lake) == before and {r.run_id for r in read_silver(spark, lake).collect()} == {"compact-1"}
    # A reader that began before the commit still sees the old files, each row once.
    assert sorted(map(str, state.drop("run_id").collect())) == before
    new = spark.read.parquet(lake.silver_claims).filter("run_id = 'compact-1'")
    assert new.select(F.input_file_name().alias("f")).distinct().count() == 2
    assert compact.compact(spark, lake, "compact-2", TS2)["partitions"] == 0
    with pytest.raises(silver.RunIdUsed):
        compact.compact(spark, lake, "compact-1", TS2)
    assert compact.vacuum(spark, lake, TS2) == 0
    assert compact.vacuum(spark, lake, TS2 + dt.timedelta(seconds=1)) == 8
    assert rows(spark, lake) == before and data_files(spark.read.parquet(lake.silver_claims)) == 2
    # New runs are compacted together with the earlier result.
    deliver(spark, lake, 3, 8)
    assert compact.compact(spark, lake, "compact-3", TS2)["rows"] == 11
    assert len(rows(spark, lake)) == 11
    assert {r.run_id for r in read_silver(spark, lake).collect()} == {"compact-3"}


def test_a_compaction_that_dies_before_its_commit_changes_nothing(spark, lake, monkeypatch):
    deliver(spark, lake, 4)
    before = rows(spark, lake)

    def boom(*a):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(compact, "dated_runs", boom)
        with pytest.raises(RuntimeError):
            compact.compact(spark, lake, "compact-1", TS2)
    assert spark.read.parquet(lake.silver_claims).count() == 8
    assert rows(spark, lake) == before and read_compactions(spark, lake).count() == 0
    assert compact.compact(spark, lake, "compact-1", TS2)["rows"] == 4  # the same id, again
    assert rows(spark, lake) == before


def test_gold_after_compaction(spark, lake):
    deliver(spark, lake, 4)
    gold.run_gold(spark, lake, TS1, DEFAULT)
    first = sorted(map(str, spark.read.parquet(lake.provider).drop("last_updated_timestamp").collect()))
    compact.compact(spark, lake, "compact-1", TS2)
    compact.vacuum(spark, lake, TS2 + dt.timedelta(days=1))
    report = gold.run_gold(spark, lake, TS2, DEFAULT)
    assert report.filter(~F.col("passed")).count() == 0 and report.count() == 2
    assert sorted(map(str, spark.read.parquet(lake.provider).drop("last_updated_timestamp").collect())) == first


def test_packing_by_size(spark):
    sizes = [("2001-01", f"r{i}", b, f) for i, (b, f) in enumerate([(10, 1), (10, 1), (40, 1), (45, 1), (49, 1), (60, 9)])]
    sizes += [("2001-02", "r0", 10, 1), ("2001-03", "r0", 10, 4)]
    df = spark.createDataFrame(sizes, "claim_month string, run_id string, bytes long, files long")
    got = {(r.claim_month, r.run_id): r.bin for r in compact.pack(df, 100).collect()}
    assert got == {("2001-01", "r0"): 0, ("2001-01", "r1"): 0, ("2001-01", "r2"): 0, ("2001-01", "r3"): 0,
                   ("2001-03", "r0"): 0}
    assert compact.pack(df, 30).count() == 3


def test_an_empty_lake(spark, lake):
    assert compact.compact(spark, lake, "compact-1", TS1)["partitions"] == 0
    assert compact.vacuum(spark, lake, TS1) == 0
    assert not os.path.exists(local_path(lake.silver_claims))
