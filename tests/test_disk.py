"""What the file lake keeps on disk: packed files and tables, no shuffle files of ended writes, no claims that only fed it."""

import collections
import gzip
import os
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_files import TS1, claim_row, write_file
from test_state_shuffles import claims, plan

from payerlake.config import FIXTURE
from payerlake.operators import gold_state, standardize as S, upsert
from payerlake.plans import bronze, queries_files, silver
from payerlake.session import local_path, scratch_path, store
from payerlake.sources import claims_fixture, files as FS
from payerlake.sources.claims_fixture import claims_from_orders, claims_table, drop_claims_table, has_claims_table
from payerlake.sources.lake import read_log, read_registry, read_silver
from payerlake.streaming.ingest import run_ingest

COLS = S.wire_columns("payer_c")


def found_files(path, end):
    return [f"{folder}/{f}" for folder, _, names in os.walk(local_path(path)) for f in names if f.endswith(end)]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def write_packed(lake, name, header, rows, **more):
    """The file of ``write_file``, packed by gzip."""
    write_file(lake, name, header, rows, **more)
    plain, = (f for f in found_files(lake.raw, name))
    with open(plain, "rb") as src, gzip.open(f"{plain}.gz", "wb") as out:
        out.write(src.read())
    os.remove(plain)


def orders(spark):
    li = spark.createDataFrame([(o, 20 + o, 7, n, 3.0, 100.0 * o, 0.1, 0.0, "A", "F") for o in range(1, 41) for n in (1, 2)],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    od = spark.createDataFrame([(o, o % 5) for o in range(1, 41)], "o_orderkey long, o_custkey long") \
        .selectExpr("*", "timestamp'1997-03-01' + make_interval(0, 0, 0, int(o_orderkey)) AS o_orderdate")
    cu = spark.createDataFrame([(c, ["FURNITURE", "BUILDING", "AUTOMOBILE"][c % 3]) for c in range(5)], "c_custkey long, c_mktsegment string")
    return li, od, cu


def test_line_items_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(claims_from_orders(*orders(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Customers and orders by customer, then orders and line items by order; no claims by customer.
    assert len(re.findall(r"Exchange hashpartitioning\((c|o)_custkey", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\((l|o)_orderkey", text)) == 2


def test_rows_without_partners_or_with_several(spark):
    li, od, cu = orders(spark)
    li = li.unionByName(li.filter("l_orderkey = 1")).unionByName(li.filter("l_orderkey = 2").withColumn("l_orderkey", F.lit(None).cast("long")))
    od = od.unionByName(od.filter("o_orderkey = 1")).withColumn("o_custkey", F.when(F.col("o_orderkey") != 3, F.col("o_custkey")))
    cu = cu.unionByName(cu.filter("c_custkey = 1"))
    counts = collections.Counter(r.claim_id.split("-")[1] for r in claims_from_orders(li, od, cu).collect())
    assert counts["1"] == 2 * 2 * 2 * 2 and "3" not in counts and counts["2"] == 2 and counts["6"] == 4 and len(counts) == 39


def test_feeds_are_packed_and_read_back(spark, lake):
    rows = store(claims_from_orders(*orders(spark)), "test-claims")
    FS.write_feeds(rows, lake.raw, FIXTURE)
    assert found_files(lake.raw, ".csv.gz") and not found_files(lake.raw, ".csv")
    assert sum(r.record_count for r in bronze.register_new_files(spark, lake, TS1).collect()) == rows.count() == 80
    silver.run_silver(spark, lake, "run-1", TS1, FIXTURE)
    assert sum(r.records_read for r in read_log(spark, lake).filter("status = 'completed'").collect()) == 80


def test_plain_and_packed_files_are_alike(spark, lake):
    write_file(lake, "a.csv", COLS, [claim_row(CLAIM_ID="plain")])
    write_packed(lake, "b.csv", COLS[::-1], [claim_row(CLAIM_ID=f"packed-{i}")[::-1] for i in range(3)])
    write_packed(lake, "c.csv", COLS[1:], [["x"] * (len(COLS) - 1)])
    bronze.register_new_files(spark, lake, TS1)
    assert {r.file_name: r.record_count for r in read_registry(spark, lake).collect()} == {"a.csv": 1, "b.csv.gz": 3, "c.csv.gz": 1}
    assert silver.run_silver(spark, lake, "run-1", TS1, FIXTURE)["failed"] == 1
    assert {r.claim_id for r in read_silver(spark, lake).collect()} == {"plain", "packed-0", "packed-1", "packed-2"}


def test_packed_files_stream(spark, lake):
    write_packed(lake, "a.csv", COLS, [claim_row(CLAIM_ID="packed")])
    run_ingest(spark, lake, TS1, FIXTURE)
    assert [r.claim_id for r in read_silver(spark, lake).collect()] == ["packed"]


def test_tables_are_packed_well(spark, lake):
    rows = claims(spark, [("payer_a", "1", "p", "Denied", "1", "0")])
    upsert.overwrite_partitions(gold_state.codes(rows), lake.state("codes"), ["year_month"], cluster=False)
    file, = found_files(lake.state("codes"), ".parquet")
    assert {pq.ParquetFile(file).metadata.row_group(0).column(i).compression for i in range(2)} == {"ZSTD"}


def test_writes_leave_no_shuffle_files(spark, lake):
    def dealt():
        return spark.range(2000).selectExpr("id", "id % 3 AS k").repartition(4, "id")
    before, held = shuffle_files(spark), [dealt() for _ in range(3)]  # held: no plan may be collected meanwhile
    stored = store(held[0], "test-dealt")
    upsert.append(held[1], lake.registry, ["k"])
    upsert.overwrite_partitions(held[2], lake.log, ["k"])
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    # The setting is that of the writes alone, and what has been written can be read and dealt again.
    assert len(held[0].collect()) == len(held[0].collect()) == stored.count() == 2000
    assert shuffle_files(spark) - before


def test_state_rows_are_dealt_once(spark):
    for build in (gold_state.measures, gold_state.codes):
        text = plan(build(claims(spark, [("payer_a", "1", "p", "Denied", "1", "0")])))
        assert text.count("Exchange hashpartitioning(year_month#") == text.count("Exchange ") == 1


def test_groups_of_null_keys_stay_whole(spark):
    rows = [(None, None, "p", "Denied", "1", "0"), (None, None, None, "Denied", "2", "0"), ("payer_a", None, "p", "Denied", "4", "0")]
    got = sorted((r.payer_name or "", r.claims, int(r.billed)) for r in gold_state.measures(claims(spark, rows)).collect())
    assert got == [("", 2, 3), ("payer_a", 1, 4)]
    assert sorted((r.kind, r.provider_id, r.value, r.n) for r in gold_state.codes(claims(spark, rows)).collect()) == [
        ("dx", None, "A01", 3), ("px", None, "90000", 3)]


def test_claims_stored_for_the_lake_alone_are_dropped(spark, tmp_path, monkeypatch):
    for name, table in zip(("lineitem", "orders", "customer"), orders(spark), strict=True):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    sf = str(tmp_path)
    queries_files.batch_lake(spark, sf)
    assert not has_claims_table(spark, sf)
    # Claims that were there before stay: others may be reading them.
    rows = claims_table(spark, sf)
    monkeypatch.setattr(queries_files, "_LAKES", {})
    queries_files.batch_lake(spark, sf)
    assert has_claims_table(spark, sf) and rows.count() == 80
    drop_claims_table(spark, sf)
    assert not has_claims_table(spark, sf) and claims_table(spark, sf).count() == 80
    assert claims_fixture._STORED
