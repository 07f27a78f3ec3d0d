"""The flagged claims that a silver run stores between reading its files and publishing them."""

import dataclasses

import pytest
from test_files import TS1, claim_row, write_file

from payerlake.config import FIXTURE
from payerlake.operators import standardize as S
from payerlake.plans import bronze, silver
from payerlake.session import store
from payerlake.sources import files as FS
from payerlake.sources.lake import read_quarantine, read_registry, read_silver

COLS = S.wire_columns("payer_c")


def flagged(spark, lake, cfg):
    write_file(lake, "a.csv", COLS, [claim_row(CLAIM_ID="good-1"), claim_row(CLAIM_ID="bad-1", PROC_CD="x")])
    write_file(lake, "b.csv", COLS[::-1], [claim_row(CLAIM_ID="good-2")[::-1], claim_row(CLAIM_ID="bad-2", PROC_CD="x")[::-1]])
    bronze.register_new_files(spark, lake, TS1)
    files = store(read_registry(spark, lake), "files")
    return spark.read.parquet(silver.flag_claims(spark, silver.scans(spark, files, cfg), cfg=cfg))


def test_only_rejected_claims_keep_their_wire_row(spark, lake):
    rows = {r.claim_id: r.raw_record for r in flagged(spark, lake, FIXTURE).collect()}
    assert {k for k, v in rows.items() if v} == {"bad-1", "bad-2"}
    assert set(rows) == {"good-1", "good-2", "bad-1", "bad-2"}
    assert all(f'"CLAIM_ID":"{k}"' in rows[k] and '"PROC_CD":"x"' in rows[k] for k in ("bad-1", "bad-2"))


def test_columns_of_the_run_are_not_stored_with_every_claim(spark, lake):
    stored = flagged(spark, lake, FIXTURE)
    assert not {"run_id", "ingestion_timestamp", "processing_date", "claim_month"} & set(stored.columns)
    silver.run_silver(spark, lake, "run-1", TS1, FIXTURE)
    row = read_silver(spark, lake).filter("claim_id = 'good-1'").first()
    assert (row.run_id, row.ingestion_timestamp, row.processing_date) == ("run-1", TS1, FIXTURE.as_of)
    assert row.claim_month == f"{row.claim_date:%Y-%m}"
    assert {r.claim_id for r in read_quarantine(spark, lake).collect()} == {"bad-1", "bad-2"}


def test_with_dedup_every_claim_keeps_its_wire_row_and_an_id_of_its_own(spark, lake):
    rows = flagged(spark, lake, dataclasses.replace(FIXTURE, dedup=True)).collect()
    assert all(f'"CLAIM_ID":"{r.claim_id}"' in r.raw_record for r in rows)
    assert len({r.row_id for r in rows}) == len(rows) == 4


@pytest.mark.parametrize("batches", [1, 4])
def test_claims_without_an_id_have_no_batch(spark, batches):
    ids = spark.createDataFrame([("a",), (None,)], "claim_id string")
    got = [r.b for r in ids.select(FS.file_batch(dataclasses.replace(FIXTURE, files_per_month=batches)).alias("b")).collect()]
    assert got[1] is None and 0 <= got[0] < batches


def test_lines_of_blanks_quotes_and_marks_are_no_records(spark, lake):
    write_file(lake, "a.csv", COLS, [claim_row(CLAIM_ID="a"), [""], ["  "], ['""'], ["\ufeff"], ['" "']])
    assert bronze.register_new_files(spark, lake, TS1).first().record_count == 1
