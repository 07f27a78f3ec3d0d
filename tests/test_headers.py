"""Columns mapped by name, reads of single files, files that have gone, streams that start over."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_files import TS1, TS2, claim_row, write_file

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import standardize as S
from payerlake.plans import bronze, silver
from payerlake.session import discard, local_path, scratch_path
from payerlake.sources import files as FS
from payerlake.sources.lake import read_log, read_quarantine, read_registry, read_silver
from payerlake.streaming.ingest import run_ingest

COLS = S.wire_columns("payer_c")


def states(spark, lake):
    return {os.path.basename(r.bronze_file_path): r for r in silver.latest_by_file(read_log(spark, lake)).collect()}


def test_columns_are_mapped_by_name(spark, lake):
    plain = claim_row(CLAIM_ID="plain")
    write_file(lake, "plain.csv", COLS, [plain])
    write_file(lake, "reversed.csv", COLS[::-1], [claim_row(CLAIM_ID="reversed")[::-1]])
    more = ["note", *COLS[:4], '"free, text"', *COLS[4:], "note"]
    row = claim_row(CLAIM_ID="more")
    write_file(lake, "more.csv", more, [["first", *row[:4], '"a, b"', *row[4:], "second"]])
    write_file(lake, "case.csv", [f'" {c.lower()} "' for c in COLS], [claim_row(CLAIM_ID="case")])
    write_file(lake, "mark.csv", ["\ufeff" + COLS[0], *COLS[1:]], [claim_row(CLAIM_ID="mark")])
    write_file(lake, "twice.csv", [*COLS, "CLAIM_ID"], [[*claim_row(CLAIM_ID="twice"), "other"]])
    write_file(lake, "short.csv", COLS, [claim_row(CLAIM_ID="short")[:-3]])
    bronze.register_new_files(spark, lake, TS1)
    out = silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    assert (out["files"], out["failed"], out["error"]) == (7, 0, None)
    rows = {r.claim_id: r for r in read_silver(spark, lake).collect()}
    assert set(rows) == {"plain", "reversed", "more", "case", "mark", "twice"}
    own = ("claim_id", "source_file_path")
    assert len({tuple(v for k, v in r.asDict().items() if k not in own) for r in rows.values()}) == 1
    assert {r.claim_id for r in read_quarantine(spark, lake).collect()} == {"short"}
    assert all(s.status == "completed" and s.records_read == 1 for s in states(spark, lake).values())


def test_raw_record_keeps_every_column(spark, lake):
    header = ["extra", *COLS[::-1], "extra", ""]
    write_file(lake, "a.csv", header, [["e1", *claim_row(CLAIM_ID="q", PROC_CD="")[::-1], "e2", "e3"]])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    raw = read_quarantine(spark, lake).first().raw_record
    assert all(part in raw for part in ('"CLAIM_ID":"q"', '"extra":"e1"', "e2", "e3"))


@pytest.mark.parametrize("size", [1, 2, 100])
def test_blocks_of_files(spark, lake, monkeypatch, size):
    monkeypatch.setattr(FS, "FILES_A_SCAN", size)
    monkeypatch.setattr(silver, "SCANS_A_JOB", 2)
    for i in range(5):
        write_file(lake, f"{i}.csv", COLS if i % 2 else COLS[::-1], [claim_row(CLAIM_ID=str(i))[::1 if i % 2 else -1]])
    assert [len(b) for b in FS.path_blocks(FS.list_files(spark, lake.raw))] == {1: [1] * 5, 2: [2, 2, 1], 100: [5]}[size]
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    assert {r.claim_id for r in read_silver(spark, lake).collect()} == set("01234")


def test_one_new_file_among_many_is_the_only_one_read(spark, lake, monkeypatch):
    for i in range(300):
        write_file(lake, f"old {i}.csv", COLS, [claim_row(CLAIM_ID=f"old{i}")])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    assert read_silver(spark, lake).count() == 300
    write_file(lake, "new [1]{a}*.csv", COLS, [claim_row(CLAIM_ID="new")])
    read, real = [], FS.read_paths

    def watched(*a, **k):
        rows = real(*a, **k)
        read.append(rows.inputFiles())
        return rows
    monkeypatch.setattr(FS, "read_paths", watched)
    assert bronze.register_new_files(spark, lake, TS2).count() == 1
    silver.run_silver(spark, lake, "run-2", TS2, DEFAULT)
    assert [len(f) for f in read] == [1, 1] and read_silver(spark, lake).count() == 301


def test_listing_from_a_time_on(spark, lake):
    write_file(lake, "old.csv", COLS, [claim_row(CLAIM_ID="old")])
    folder = f"{local_path(lake.raw)}/provider=payer_c/year=2001/month=1"
    os.utime(f"{folder}/old.csv", (1_000_000_000, 1_000_000_000))
    assert bronze.listing_start(spark, lake, dt.timedelta(hours=1)) is None
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    bronze.register_new_files(spark, lake, now)
    start = bronze.listing_start(spark, lake, dt.timedelta(hours=1))
    assert start == now - dt.timedelta(hours=1)
    write_file(lake, "new.csv", COLS, [claim_row(CLAIM_ID="new")])
    listed = FS.list_files(spark, lake.raw, start)
    assert [os.path.basename(r.file_path) for r in listed.collect()] == ["new.csv"]
    assert bronze.register_new_files(spark, lake, now, listed).count() == 1
    assert read_registry(spark, lake).count() == 2


def test_a_file_that_has_gone_fails_alone(spark, lake):
    for name in ("a", "b"):
        write_file(lake, f"{name}.csv", COLS, [claim_row(CLAIM_ID=name)])
    bronze.register_new_files(spark, lake, TS1)
    folder = f"{local_path(lake.raw)}/provider=payer_c/year=2001/month=1"
    os.remove(f"{folder}/a.csv")
    out = silver.run_silver(spark, lake, "run-1", TS1, DEFAULT)
    assert (out["files"], out["failed"], out["error"]) == (2, 1, None)
    assert states(spark, lake)["a.csv"].error_message.startswith("File not found")
    assert [r.claim_id for r in read_silver(spark, lake).collect()] == ["b"]
    # All gone: the run logs that and publishes nothing.
    out = silver.run_silver(spark, lake, "run-2", TS2, DEFAULT)
    assert (out["files"], out["failed"]) == (1, 1) and read_silver(spark, lake).count() == 1


def test_a_stream_with_a_new_checkpoint_loses_nothing(spark, lake):
    """Batch 0 of the second query is not batch 0 of the first, also in the first one's folder."""
    for i, checkpoint in enumerate(("one", "two", "one")):
        where = f"{lake.checkpoints}/{checkpoint}"
        if i == 2:
            shutil.rmtree(local_path(where))
        write_file(lake, f"{i}.csv", COLS, [claim_row(CLAIM_ID=str(i))])
        run_ingest(spark, lake, TS1, DEFAULT, checkpoint=where)
        assert {r.claim_id for r in read_silver(spark, lake).collect()} == set(map(str, range(i + 1)))
    run_ingest(spark, lake, TS2, DEFAULT, checkpoint=where)  # restarted, with nothing new
    assert read_silver(spark, lake).count() == 3 and read_registry(spark, lake).count() == 3


def test_stream_batches_carry_their_own_time(spark, lake):
    write_file(lake, "a.csv", COLS, [claim_row()])
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    run_ingest(spark, lake, None, DEFAULT)
    row = read_log(spark, lake).select(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t")).first()
    assert before <= dt.datetime.fromisoformat(row.t) <= before + dt.timedelta(minutes=5)


def test_only_scratch_can_be_discarded(spark, lake):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    assert not os.path.exists(local_path(path))
    with pytest.raises(ValueError):
        discard(spark, "/tmp/elsewhere")
