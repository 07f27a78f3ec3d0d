"""Table maintenance helpers."""

import datetime as dt

from payerlake.operators import upsert
from payerlake.session import scratch_path


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "dyn")
    a = spark.createDataFrame([("2001-01", 1), ("2001-02", 2)], "year_month string, v int")
    upsert.overwrite_partitions(a, path, ["year_month"])
    b = spark.createDataFrame([("2001-02", 20), ("2001-03", 30)], "year_month string, v int")
    upsert.overwrite_partitions(b, path, ["year_month"])
    got = sorted((r.year_month, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2001-01", 1), ("2001-02", 20), ("2001-03", 30)]


def test_replace_keys(spark):
    cur = spark.createDataFrame([("p1", 1), ("p2", 2)], "provider_id string, n int")
    new = spark.createDataFrame([("p2", 20), ("p3", 30)], "provider_id string, n int")
    got = sorted(tuple(r) for r in upsert.replace_keys(cur, new, "provider_id").collect())
    assert got == [("p1", 1), ("p2", 20), ("p3", 30)]


def test_latest_state_hot_key(spark):
    t0 = dt.datetime(2001, 1, 1)
    rows = [("k", t0 + dt.timedelta(seconds=i), i) for i in range(5000)] + [("j", t0, 7)]
    ev = spark.createDataFrame(rows, "id string, ts timestamp, v int").repartition(8)
    got = {r.id: r.v for r in upsert.latest_state(ev, "id", ["ts"]).collect()}
    assert got == {"k": 4999, "j": 7}


def test_ensure_and_drop_tables(spark):
    import pytest
    from payerlake.sources import lake as L
    lk = L.Lake.scratch(spark, "drop")
    created = L.ensure_tables(spark, lk)
    assert len(created) == 4
    assert L.ensure_tables(spark, lk) == []
    assert L.read_silver(spark, lk).count() == 0
    # seeded tables take partitioned writes afterwards
    import datetime as dt
    from payerlake.config import FIXTURE as DEFAULT
    from payerlake.plans import bronze, silver
    from payerlake.sources import files as FS
    from payerlake.sources.claims_fixture import claims_table
    from conftest import SF_SMALL
    FS.write_feeds(claims_table(spark, SF_SMALL), lk.raw, DEFAULT)
    bronze.register_new_files(spark, lk, dt.datetime(2001, 6, 30))
    silver.run_silver(spark, lk, "run-s", dt.datetime(2001, 6, 30), DEFAULT)
    assert L.read_silver(spark, lk).count() + L.read_quarantine(spark, lk).count() == \
        claims_table(spark, SF_SMALL).count()
    with pytest.raises(PermissionError):
        L.drop_tables(spark, lk)
    assert sorted(L.drop_tables(spark, lk, confirm=True)) == sorted(
        ["bronze.claims_files", "silver.claims", "silver.claims_quarantine", "silver.processing_log"])
    assert L.drop_tables(spark, lk, confirm=True) == []
