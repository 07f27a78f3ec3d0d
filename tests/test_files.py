"""Bronze / silver over real CSV files: registry, idempotence, failures, commit protocol."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import standardize as S
from payerlake.plans import bronze, gold, silver
from payerlake.sources import files as FS
from payerlake.sources.claims_fixture import claims_table
from payerlake.sources.lake import read_log, read_quarantine, read_registry, read_silver
from payerlake.session import local_path

from conftest import SF_SMALL

TS1 = dt.datetime(2001, 6, 30, 1)
TS2 = dt.datetime(2001, 6, 30, 2)


def write_csv(path, header, rows):
    import os
    os.makedirs(local_path(path), exist_ok=True)
    with open(local_path(path) + "/data.csv", "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def test_registry_counts_and_idempotence(spark, lake):
    claims = claims_table(spark, SF_SMALL)
    FS.write_feeds(claims, lake.raw, DEFAULT)
    # a header-only file is registered with 0 rows
    write_csv(f"{lake.raw}/provider=payer_a/year=2030/month=1/batch=0", S.wire_columns("payer_a"), [])
    first = bronze.register_new_files(spark, lake, TS1).count()
    again = bronze.register_new_files(spark, lake, TS2).count()
    reg = read_registry(spark, lake)
    assert again == 0                       # same files twice → registered once
    assert reg.count() == first
    assert reg.agg(F.sum("record_count")).first()[0] == claims.count()
    empty = reg.filter(F.col("file_year") == 2030).first()
    assert empty.record_count == 0 and empty.payer_name == "payer_a"


def test_silver_from_files_matches_rules_and_log(spark, lake):
    claims = claims_table(spark, SF_SMALL)
    FS.write_feeds(claims, lake.raw, DEFAULT)
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-a", TS1, DEFAULT)
    ok, bad = read_silver(spark, lake).count(), read_quarantine(spark, lake).count()
    assert ok + bad == claims.count()
    latest = silver.latest_by_file(read_log(spark, lake))
    agg = latest.agg(F.sum("records_read"), F.sum("records_accepted"), F.sum("records_quarantined")).first()
    assert tuple(agg) == (ok + bad, ok, bad)
    assert set(r.status for r in latest.select("status").distinct().collect()) == {"completed"}
    # nothing left to do: a second run is a no-op
    assert silver.run_silver(spark, lake, "run-b", TS2, DEFAULT)["files"] == 0
    assert read_silver(spark, lake).count() == ok
    # quarantine keeps the raw wire record
    raw = read_quarantine(spark, lake).select("raw_record").first().raw_record
    assert raw.startswith("{")


def test_unknown_payer_logged_as_failed(spark, lake):
    write_csv(f"{lake.raw}/provider=payer_x/year=2001/month=1/batch=0", ["a", "b"], [["1", "2"]])
    bronze.register_new_files(spark, lake, TS1)
    out = silver.run_silver(spark, lake, "run-x", TS1, DEFAULT)
    assert out["unknown_payers"] == ["payer_x"]
    log = silver.latest_by_file(read_log(spark, lake)).first()
    assert log.status == "failed" and "Unknown payer" in log.error_message
    assert read_silver(spark, lake).count() == 0


def test_crash_before_log_is_invisible_and_retry_replaces(spark, lake, monkeypatch):
    claims = claims_table(spark, SF_SMALL)
    FS.write_feeds(claims.filter(F.col("payer_name") == "payer_c"), lake.raw, DEFAULT)
    bronze.register_new_files(spark, lake, TS1)
    real_commit, real_events = silver.commit_log, silver.log_events

    def boom(*a, **k):
        raise RuntimeError("driver lost")
    calls = []

    def at_commit(*a):
        calls.append(1)
        real_commit(*a) if len(calls) == 1 else boom()  # the first call logs the start
    # the driver dies at the commit point, and also while logging the failure
    monkeypatch.setattr(silver, "commit_log", at_commit)
    monkeypatch.setattr(silver, "log_events",
                        lambda *a, **k: boom() if isinstance(k.get("error"), str) else real_events(*a, **k))
    with pytest.raises(RuntimeError):
        silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    # data partitions were written, the log says running, but nothing is visible
    assert spark.read.parquet(lake.silver_claims).count() > 0
    assert read_silver(spark, lake).count() == 0
    assert {r.status for r in read_log(spark, lake).select("status").distinct().collect()} == {"running"}
    monkeypatch.setattr(silver, "commit_log", real_commit)
    monkeypatch.setattr(silver, "log_events", real_events)
    silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)   # retry with the same run id
    n = claims.filter(F.col("payer_name") == "payer_c").count()
    assert read_silver(spark, lake).count() + read_quarantine(spark, lake).count() == n
    assert spark.read.parquet(lake.silver_claims).count() == read_silver(spark, lake).count()


def test_gold_refresh_reconciles(spark, lake):
    claims = claims_table(spark, SF_SMALL)
    FS.write_feeds(claims, lake.raw, DEFAULT)
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-g", TS1, DEFAULT)
    report = gold.run_gold(spark, lake, TS1, DEFAULT)
    assert report.filter(~F.col("passed")).count() == 0
    monthly = spark.read.parquet(lake.monthly)
    s = read_silver(spark, lake)
    assert monthly.agg(F.sum("total_claims")).first()[0] == s.count()
    rows = monthly.count()
    # running again is idempotent (re-read: the overwrite replaced the files)
    gold.run_gold(spark, lake, TS2, DEFAULT)
    assert spark.read.parquet(lake.monthly).count() == rows
    assert spark.read.parquet(lake.provider).count() == s.select("provider_id").distinct().count()


def test_vanished_month_is_dropped_from_gold(spark, lake):
    """A month whose silver rows disappear (its run is withdrawn) leaves gold."""
    from payerlake.session import local_path
    import shutil
    claims = claims_table(spark, SF_SMALL)
    FS.write_feeds(claims.filter(F.year("claim_date") == 1996), lake.raw, DEFAULT)
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-v1", TS1, DEFAULT)
    FS.write_feeds(claims.filter(F.year("claim_date") == 1997), lake.raw, DEFAULT)
    bronze.register_new_files(spark, lake, TS2)
    silver.run_silver(spark, lake, "run-v2", TS2, DEFAULT)
    gold.run_gold(spark, lake, TS2, DEFAULT)
    months = {r.year_month for r in spark.read.parquet(lake.monthly).select("year_month").distinct().collect()}
    assert any(m.startswith("1997") for m in months)
    # withdraw run 2 (its log rows), then refresh gold
    shutil.rmtree(local_path(lake.log) + "/run_id=run-v2")
    report = gold.run_gold(spark, lake, TS2, DEFAULT)
    left = {r.year_month for r in spark.read.parquet(lake.monthly).select("year_month").distinct().collect()}
    assert not any(m.startswith("1997") for m in left)
    assert report.filter(~F.col("passed")).count() == 0


def claim_row(payer="payer_c", **changes):
    """A valid feed-C claim as a wire row."""
    row = dict(CLAIM_ID="c-1", SUBSCRIBER_ID="PAT1", RENDERING_PROVIDER_NPI="7", RECEIVED_DT="20010301",
               SVC_FROM_DT="20010225", SVC_TO_DT="20010226", DIAG_CD="E11.9", PROC_CD="99213", BILLED_AMT="100.00",
               ALLOWED_AMT="80.00", PAID_AMT="76.00", CLM_STATUS="PAID", CLM_TYPE="Outpatient") | changes
    return [row[c] for c in S.wire_columns(payer)]


def write_file(lake, name, header, rows, payer="payer_c", month=1):
    import os
    folder = f"{local_path(lake.raw)}/provider={payer}/year=2001/month={month}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write("".join(",".join(r) + "\n" for r in ([header] if header else []) + rows))


def test_one_bad_file_leaves_the_others_alone(spark, lake):
    """A header that lacks columns, an empty file and an unknown payer fail by themselves."""
    cols = S.wire_columns("payer_c")
    write_file(lake, "ok.csv", cols, [claim_row()])
    write_file(lake, "lacking.csv", cols[1:], [["x"] * (len(cols) - 1)])
    write_file(lake, "empty.csv", [""], [])
    write_file(lake, "header only.csv", cols, [])
    write_file(lake, "data.csv", ["a", "b"], [["1", "2"]], payer="payer_x")
    bronze.register_new_files(spark, lake, TS1)
    out = silver.run_silver(spark, lake, "run-h", TS1, DEFAULT)
    assert (out["files"], out["failed"], out["error"], out["unknown_payers"]) == (5, 3, None, ["payer_x"])
    assert [r.claim_id for r in read_silver(spark, lake).collect()] == ["c-1"]
    log = {r.bronze_file_path.rpartition("/")[2]: r for r in silver.latest_by_file(read_log(spark, lake)).collect()}
    assert {n: r.status for n, r in log.items()} == {"ok.csv": "completed", "header%20only.csv": "completed",
                                                     "lacking.csv": "failed", "empty.csv": "failed", "data.csv": "failed"}
    assert log["lacking.csv"].error_message == "Columns missing from the header: CLAIM_ID"
    assert log["empty.csv"].error_message.startswith("No header")
    assert log["header%20only.csv"].records_read == 0
    # the failed ones stay unprocessed, so the next run retries them
    assert silver.unprocessed_files(spark, lake).count() == 3


def test_file_names_with_blanks_and_percent_signs(spark, lake):
    cols = S.wire_columns("payer_c")
    write_file(lake, "claims march.csv", cols, [claim_row(CLAIM_ID="a"), claim_row(CLAIM_ID="b")], month=3)
    write_file(lake, "50%+x.csv", cols, [claim_row(CLAIM_ID="c")], month=4)
    bronze.register_new_files(spark, lake, TS1)
    reg = {r.file_name: r for r in read_registry(spark, lake).collect()}
    assert {n: r.record_count for n, r in reg.items()} == {"claims march.csv": 2, "50%+x.csv": 1}
    silver.run_silver(spark, lake, "run-n", TS1, DEFAULT)
    log = silver.latest_by_file(read_log(spark, lake)).collect()
    assert sorted((r.records_read, r.records_accepted) for r in log) == [(1, 1), (2, 2)]
    assert bronze.register_new_files(spark, lake, TS2).count() == 0
    # the stream finds nothing left to do
    from payerlake.streaming.ingest import run_ingest
    run_ingest(spark, lake, TS2, DEFAULT)
    assert read_silver(spark, lake).count() == 3


def test_retry_on_another_day_replaces_everything(spark, lake, monkeypatch):
    """The first attempt's partitions go, also those that the retry does not write."""
    cols = S.wire_columns("payer_c")
    write_file(lake, "a.csv", cols, [claim_row(), claim_row(CLAIM_ID="c-2", PROC_CD="")])
    bronze.register_new_files(spark, lake, TS1)
    real = silver.commit_log
    calls = []

    def fails_second(*a):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("driver lost")
        real(*a)
    monkeypatch.setattr(silver, "commit_log", fails_second)
    with pytest.raises(RuntimeError):
        silver.run_silver(spark, lake, "run-d", dt.datetime(2001, 6, 29, 23), DEFAULT)
    monkeypatch.setattr(silver, "commit_log", real)
    assert spark.read.parquet(lake.quarantine).count() == 1
    silver.run_silver(spark, lake, "run-d", dt.datetime(2001, 6, 30, 2), DEFAULT)
    assert read_quarantine(spark, lake).count() == 1 and read_silver(spark, lake).count() == 1


def test_completed_run_id_is_refused(spark, lake):
    cols = S.wire_columns("payer_c")
    write_file(lake, "a.csv", cols, [claim_row()])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "nightly", TS1, DEFAULT)
    write_file(lake, "b.csv", cols, [claim_row(CLAIM_ID="c-2")])
    bronze.register_new_files(spark, lake, TS2)
    with pytest.raises(silver.RunIdUsed):
        silver.run_silver(spark, lake, "nightly", TS2, DEFAULT)
    assert read_silver(spark, lake).count() == 1
    silver.run_silver(spark, lake, "nightly-2", TS2, DEFAULT)
    assert {r.claim_id for r in read_silver(spark, lake).collect()} == {"c-1", "c-2"}


def test_batches_of_more_than_sixteen(spark):
    import dataclasses
    many = dataclasses.replace(DEFAULT, files_per_month=40)
    ids = spark.range(4000).selectExpr("concat('claim', id) AS claim_id")
    assert ids.select(FS.file_batch(many).alias("b")).distinct().count() == 40


def test_a_paid_amount_far_above_the_bill_does_not_stop_gold(spark, lake):
    cols = S.wire_columns("payer_c")
    write_file(lake, "a.csv", cols, [claim_row(BILLED_AMT="1.00", ALLOWED_AMT="", PAID_AMT="5000.00")])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-o", TS1, DEFAULT)
    gold.run_gold(spark, lake, TS1, DEFAULT)
    assert spark.read.parquet(lake.monthly).first().avg_reimbursement_rate is None


def test_gold_of_an_empty_lake(spark, lake):
    assert gold.run_gold(spark, lake, TS1, DEFAULT).count() == 0


def test_a_withdrawn_provider_leaves_gold(spark, lake):
    import shutil
    cols = S.wire_columns("payer_c")
    for name, provider, run in (("a.csv", "111", "run-1"), ("b.csv", "222", "run-2")):
        write_file(lake, name, cols, [claim_row(CLAIM_ID=name, RENDERING_PROVIDER_NPI=provider)])
        bronze.register_new_files(spark, lake, TS1)
        silver.run_silver(spark, lake, run, TS1, DEFAULT)
    gold.run_gold(spark, lake, TS1, DEFAULT)
    shutil.rmtree(local_path(lake.log) + "/run_id=run-1")
    gold.run_gold(spark, lake, TS2, DEFAULT)
    assert [r.provider_id for r in spark.read.parquet(lake.provider).collect()] == ["222"]


def test_malformed_wire_values_end_to_end(spark, lake):
    """A feed-C file with broken values: nothing throws, bad rows are
    quarantined with the right reasons and keep their raw wire record."""
    cols = S.wire_columns("payer_c")
    good = dict(CLAIM_ID="c-ok", SUBSCRIBER_ID="PAT1", RENDERING_PROVIDER_NPI="7", RECEIVED_DT="20010301",
                SVC_FROM_DT="20010225", SVC_TO_DT="20010226", DIAG_CD=" e11.9 ", PROC_CD=" 99213 ",
                BILLED_AMT="100.00", ALLOWED_AMT="80.00", PAID_AMT="76.00", CLM_STATUS="paid",
                CLM_TYPE="Outpatient")
    rows = [good,
            dict(good, CLAIM_ID="c-date", RECEIVED_DT="20011301"),        # month 13
            dict(good, CLAIM_ID="c-junk", BILLED_AMT="abc"),
            dict(good, CLAIM_ID="c-huge", BILLED_AMT="123456789012.5"),    # overflows decimal(10,2)
            dict(good, CLAIM_ID="c-empty", PROC_CD=""),
            dict(good, CLAIM_ID="c-status", CLM_STATUS="")]                # empty → NULL status
    write_csv(f"{lake.raw}/provider=payer_c/year=2001/month=3/batch=0", cols,
              [[r[c] for c in cols] for r in rows])
    bronze.register_new_files(spark, lake, TS1)
    out = silver.run_silver(spark, lake, "run-m", TS1, DEFAULT)
    assert out["error"] is None
    ok = {r.claim_id: r for r in read_silver(spark, lake).collect()}
    assert set(ok) == {"c-ok"}
    assert ok["c-ok"].diagnosis_code == "E11.9" and ok["c-ok"].procedure_code == "99213"
    assert ok["c-ok"].claim_status == "Approved"
    q = {r.claim_id: r for r in read_quarantine(spark, lake).collect()}
    assert q["c-date"].rejection_reasons == ["REQUIRED_FIELD_NULL: claim_date"]
    assert q["c-junk"].rejection_reasons[0] == "REQUIRED_FIELD_NULL: billed_amount"
    assert q["c-huge"].rejection_reasons[0] == "REQUIRED_FIELD_NULL: billed_amount"
    assert q["c-empty"].rejection_reasons == ["REQUIRED_FIELD_NULL: procedure_code"]
    assert q["c-status"].rejection_reasons == ["REQUIRED_FIELD_NULL: claim_status"]
    assert '"BILLED_AMT":"abc"' in q["c-junk"].raw_record           # the original value survives
    assert '"RECEIVED_DT":"20011301"' in q["c-date"].raw_record
