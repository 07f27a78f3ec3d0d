"""Streaming ingest: exactly once across restarts and new arrivals."""

import datetime as dt

from pyspark.sql import functions as F

from payerlake.config import FIXTURE as DEFAULT
from payerlake.sources import files as FS
from payerlake.sources.claims_fixture import claims_table
from payerlake.sources.lake import read_quarantine, read_silver
from payerlake.streaming.ingest import run_ingest

from conftest import SF_SMALL


def test_stream_exactly_once(spark, lake):
    claims = claims_table(spark, SF_SMALL)
    early = F.year("claim_date") <= 1997
    FS.write_feeds(claims.filter(early), lake.raw, DEFAULT)
    run_ingest(spark, lake, dt.datetime(2001, 6, 30), DEFAULT, max_files=8)
    n1 = read_silver(spark, lake).count() + read_quarantine(spark, lake).count()
    assert n1 == claims.filter(early).count()
    run_ingest(spark, lake, dt.datetime(2001, 6, 30), DEFAULT, max_files=8)   # restart, nothing new
    assert read_silver(spark, lake).count() + read_quarantine(spark, lake).count() == n1
    FS.write_feeds(claims.filter(~early), lake.raw, DEFAULT)
    run_ingest(spark, lake, dt.datetime(2001, 6, 30), DEFAULT, max_files=8)
    total = read_silver(spark, lake).count() + read_quarantine(spark, lake).count()
    assert total == claims.count()
