"""File-based keys: bronze registry, silver from files, processing log, streaming.

The scenario is built from the given tables: canonical claims are written as
payer CSV files under Hive paths in a fresh lake folder in two deliveries
(claims up to 1998, then the rest), each followed by a bronze and a silver
run; gold is refreshed at the end.  The lake of one (session, sf_dir) is
built once and shared by the keys that read it.  In the second delivery payer_a
writes its columns in reverse order in even months, and payer_b adds columns of
its own; both are mapped by name.  It also holds three files that must fail by
themselves: one that lacks a column, one of an unknown payer and one without
any header.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import reports as RP
from ..operators import standardize as S
from ..operators import validate
from ..sources import files as FS
from ..sources.claims_fixture import CLAIM_COLUMNS, claims_table, drop_claims_table, has_claims_table
from ..sources.lake import Lake, read_quarantine, read_registry, read_silver, read_log
from ..sources.lake import table_counts
from . import bronze, gold as gold_job, silver as silver_job
from . import oracle as O
from .queries_core import CFG, FUNNEL_SQL, MONTHLY_SQL, PROVIDER_SQL, provider_out
from .registry import register

WAVE_SPLIT_YEAR = 1998
RUN_TS = (_dt.datetime(2001, 6, 30, 6, 0, 0), _dt.datetime(2001, 6, 30, 18, 0, 0))
_LAKES: dict[tuple, dict] = {}
BROKEN_YEAR = 2099


def plant_broken_files(spark, lake: Lake) -> None:
    """Three files that cannot be read as their payer's layout."""
    columns = S.wire_columns("payer_a")[1:]
    lacking = spark.createDataFrame([["x"] * len(columns)], columns)
    stranger = spark.createDataFrame([("1", "2"), ("3", "4")], ["a", "b"])
    blank = spark.createDataFrame([("",)], ["a"])
    for df, payer, header in ((lacking, "payer_a", True), (stranger, "payer_x", True), (blank, "payer_b", False)):
        df.coalesce(1).write.option("header", header).csv(f"{lake.raw}/provider={payer}/year={BROKEN_YEAR}/month=1")


def write_other_spellings(claims, lake: Lake) -> None:
    """Feeds with reordered columns (payer_a, even months) and additional ones (payer_b)."""
    def reversed_columns(feed):
        wire = S.wire_columns("payer_a")
        return feed.select(*reversed(wire), *(c for c in feed.columns if c not in wire))

    def with_more(feed):
        return feed.select(F.lit("n/a").alias("batch_note"), *feed.columns, F.lit("a, \"b\"").alias("Remark, free"))

    even = F.month("claim_date") % 2 == 0
    FS.write_feeds(claims.filter(even), lake.raw, CFG, ["payer_a"], {"payer_a": reversed_columns})
    FS.write_feeds(claims.filter(~even | (F.col("payer_name") != "payer_a")), lake.raw, CFG, arrange={"payer_b": with_more})


def _key(spark, sf):
    return (spark.sparkContext.applicationId, sf)


def batch_lake(spark, sf) -> dict:
    k = _key(spark, sf)
    if k in _LAKES:
        return _LAKES[k]
    lake = Lake.scratch(spark, "lake")
    found = has_claims_table(spark, sf)
    claims = claims_table(spark, sf)
    early = F.year("claim_date") <= WAVE_SPLIT_YEAR
    FS.write_feeds(claims.filter(early), lake.raw, CFG)
    bronze.register_new_files(spark, lake, RUN_TS[0])
    silver_job.run_silver(spark, lake, "run-000001", RUN_TS[0], CFG)
    write_other_spellings(claims.filter(~early), lake)
    if not found:
        # Stored for these feeds alone, and as large as they are.
        drop_claims_table(spark, sf)
    plant_broken_files(spark, lake)
    snap = f"{lake.root}/_snapshots"
    FS.describe(bronze.unregistered_files(spark, lake)).write.parquet(f"{snap}/unregistered")
    bronze.register_new_files(spark, lake, RUN_TS[1])
    silver_job.unprocessed_files(spark, lake).write.parquet(f"{snap}/unprocessed")
    silver_job.run_silver(spark, lake, "run-000002", RUN_TS[1], CFG)
    gold_job.run_gold(spark, lake, RUN_TS[1], CFG)
    _LAKES[k] = {"lake": lake, "snap": snap}
    return _LAKES[k]


def stream_lake(spark, sf) -> Lake:
    k = ("stream",) + _key(spark, sf)
    if k in _LAKES:
        return _LAKES[k]["lake"]
    from ..streaming.ingest import run_ingest
    lake = Lake.scratch(spark, "stream")
    FS.write_feeds(claims_table(spark, sf), lake.raw, CFG)
    run_ingest(spark, lake, RUN_TS[0], CFG, max_files=64)
    _LAKES[k] = {"lake": lake}
    return lake


# ------------------------------------------------------------------ oracle pieces

_BATCH = f"CAST('0x' || substr(md5(claim_id), 1, 15) AS BIGINT) % {CFG.files_per_month}"
FILES_CTE = f""",
wfiles AS (
  SELECT payer_name, CAST(year(claim_date) AS INTEGER) AS file_year,
         CAST(month(claim_date) AS INTEGER) AS file_month, {_BATCH} AS batch,
         count(*) AS record_count, count_if(len(rejection_reasons) = 0) AS accepted,
         count_if(len(rejection_reasons) > 0) AS quarantined
  FROM wflagged GROUP BY ALL
),
afiles AS (
  SELECT *, 'completed' AS status, CAST(NULL AS VARCHAR) AS failure FROM wfiles
  UNION ALL VALUES ('payer_a', 2099, 1, 0, 1, NULL, NULL, 'failed', 'Columns missing from the header'),
                   ('payer_x', 2099, 1, 0, 2, NULL, NULL, 'failed', 'Unknown payer'),
                   ('payer_b', 2099, 1, 0, 0, NULL, NULL, 'failed', 'No header')
)"""


def with_files(body: str) -> str:
    return O.wire_silver_ctes(CFG) + FILES_CTE + "\n" + body


def file_cols(df):
    p = F.col("bronze_file_path") if "bronze_file_path" in df.columns else F.col("file_path")
    return df.withColumn("file_year", FS.path_part(p, "year").cast("int")) \
             .withColumn("file_month", FS.path_part(p, "month").cast("int"))


# ------------------------------------------------------------------ bronze

REG_COLS = ["payer_name", "file_year", "file_month", "record_count", "schema_version", "processing_status"]

register("bronze_file_registry", with_files(
    "SELECT payer_name, file_year, file_month, record_count, 'v1' AS schema_version, "
    "'registered' AS processing_status FROM afiles"))(
    lambda spark, sf: read_registry(spark, batch_lake(spark, sf)["lake"]).select(*REG_COLS))

register("unregistered_files", with_files(
    f"SELECT payer_name, file_year, file_month FROM afiles WHERE file_year > {WAVE_SPLIT_YEAR}"))(
    lambda spark, sf: spark.read.parquet(batch_lake(spark, sf)["snap"] + "/unregistered")
    .select("payer_name", "file_year", "file_month"))

register("unprocessed_files", with_files(
    f"SELECT payer_name, file_year, file_month, record_count FROM afiles WHERE file_year > {WAVE_SPLIT_YEAR}"))(
    lambda spark, sf: spark.read.parquet(batch_lake(spark, sf)["snap"] + "/unprocessed")
    .select("payer_name", "file_year", "file_month", "record_count"))


_WAVE_TIME = f"CASE WHEN file_year <= {WAVE_SPLIT_YEAR} THEN '{RUN_TS[0]}' ELSE '{RUN_TS[1]}' END"


def _time(c):
    """Times as text, so that both engines spell them alike."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _registry(spark, sf):
    return read_registry(spark, batch_lake(spark, sf)["lake"])


register("rpt_registry_by_payer", with_files(
    "SELECT payer_name, count(*) AS file_count, sum(record_count) AS total_records, "
    f"min({_WAVE_TIME}) AS first_ingestion, max({_WAVE_TIME}) AS last_ingestion FROM afiles GROUP BY payer_name"))(
    lambda spark, sf: _registry(spark, sf).groupBy("payer_name").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("record_count").alias("total_records"),
        _time(F.min("ingestion_timestamp")).alias("first_ingestion"),
        _time(F.max("ingestion_timestamp")).alias("last_ingestion")))

register("rpt_registry_by_month", with_files(
    "SELECT file_year, file_month, count(*) AS file_count, sum(record_count) AS total_records "
    "FROM afiles GROUP BY ALL"))(
    lambda spark, sf: _registry(spark, sf).groupBy("file_year", "file_month").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("record_count").alias("total_records")))

register("rpt_registry_stats", with_files(
    "SELECT min(record_count) AS min_records, max(record_count) AS max_records, "
    f"{O.avg_dec('record_count', 0, 2, 'DECIMAL(18,2)')} AS avg_records, "
    "sum(record_count) AS total_records, count(*) AS files, true AS has_size FROM afiles"))(
    lambda spark, sf: _registry(spark, sf).agg(
        F.min("record_count").alias("min_records"), F.max("record_count").alias("max_records"),
        F.round(F.avg("record_count"), 2).cast("decimal(18,2)").alias("avg_records"),
        F.sum("record_count").alias("total_records"), F.count(F.lit(1)).alias("files"),
        (F.sum("file_size_bytes") / 1024 / 1024 > 0).alias("has_size")))

# Sizes depend on the CSV writer; that each payer has some is what both sides can say.
register("rpt_registry_size", with_files(
    "SELECT payer_name, count(*) AS files, true AS has_size FROM afiles GROUP BY payer_name"))(
    lambda spark, sf: _registry(spark, sf).groupBy("payer_name").agg(
        F.count(F.lit(1)).alias("files"), (F.sum("file_size_bytes") > 0).alias("has_size")))

register("rpt_registry_list", with_files(
    "SELECT payer_name, file_year, file_month, record_count, 'registered' AS processing_status FROM afiles "
    "ORDER BY payer_name, file_year, file_month"))(
    lambda spark, sf: _registry(spark, sf).select(
        "payer_name", "file_year", "file_month", "record_count", "processing_status")
    .orderBy("payer_name", "file_year", "file_month", "file_path"))

register("rpt_registry_recent", with_files(
    "SELECT payer_name, file_year, file_month, record_count, 'registered' AS processing_status, "
    f"{_WAVE_TIME} AS ingested FROM afiles ORDER BY ingested DESC, payer_name, file_year, file_month, batch LIMIT 10"))(
    lambda spark, sf: _registry(spark, sf).orderBy(
        F.col("ingestion_timestamp").desc(), "payer_name", "file_year", "file_month", "file_path").limit(10)
    .select("payer_name", "file_year", "file_month", "record_count", "processing_status",
            _time(F.col("ingestion_timestamp")).alias("ingested")))

# ------------------------------------------------------------------ silver from files


def _silver(spark, sf):
    return read_silver(spark, batch_lake(spark, sf)["lake"])


register("silver_from_files", with_files(f"SELECT {O.CLAIM_COLS} FROM wsilver"))(
    lambda spark, sf: _silver(spark, sf).select(*CLAIM_COLUMNS))

_QS = validate.QUARANTINE_STRING_COLUMNS
register("quarantine_from_files", with_files(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _QS)
    + ", payer_name, array_to_string(rejection_reasons, '|') AS rejection_reasons FROM wquarantine"))(
    lambda spark, sf: read_quarantine(spark, batch_lake(spark, sf)["lake"]).select(
        *_QS, "payer_name", F.array_join("rejection_reasons", "|").alias("rejection_reasons")))


def _latest(spark, sf):
    return file_cols(silver_job.latest_by_file(read_log(spark, batch_lake(spark, sf)["lake"])))


register("log_latest_state", with_files(
    "SELECT payer_name, file_year, file_month, status, CASE WHEN status = 'completed' THEN record_count END AS records_read, "
    "accepted AS records_accepted, quarantined AS records_quarantined FROM afiles"))(
    lambda spark, sf: _latest(spark, sf).select(
        "payer_name", "file_year", "file_month", "status", "records_read", "records_accepted",
        "records_quarantined"))

register("rpt_log_by_status", with_files(
    "SELECT status, count(*) AS run_count FROM afiles GROUP BY status"))(
    lambda spark, sf: silver_job.latest_log(read_log(spark, batch_lake(spark, sf)["lake"]))
    .groupBy("status").agg(F.count(F.lit(1)).alias("run_count")))

register("rpt_log_by_payer", with_files(
    "SELECT payer_name, count(*) AS files_processed, sum(record_count) AS total_read, "
    "sum(accepted) AS total_accepted, sum(quarantined) AS total_quarantined, "
    f"{O.pct_of('sum(accepted)', 'sum(record_count)')} AS acceptance_rate_pct FROM wfiles GROUP BY payer_name"))(
    lambda spark, sf: RP.log_by_payer(silver_job.latest_log(read_log(spark, batch_lake(spark, sf)["lake"]))))

register("rpt_log_recent", with_files(
    "SELECT payer_name, status, CASE WHEN status = 'completed' THEN record_count END AS records_read, "
    f"accepted AS records_accepted, quarantined AS records_quarantined, {_WAVE_TIME} AS logged FROM afiles "
    "ORDER BY logged DESC, payer_name, file_year, CAST(file_month AS VARCHAR), batch LIMIT 10"))(
    lambda spark, sf: RP.log_recent(silver_job.latest_log(read_log(spark, batch_lake(spark, sf)["lake"])))
    .select("payer_name", "status", "records_read", "records_accepted", "records_quarantined",
            _time(F.col("event_timestamp")).alias("logged")))

register("rpt_log_failed", with_files(
    f"SELECT payer_name, file_year, file_month, failure, {_WAVE_TIME} AS logged FROM afiles WHERE status = 'failed'"))(
    lambda spark, sf: file_cols(RP.log_failed(silver_job.latest_log(read_log(spark, batch_lake(spark, sf)["lake"]))))
    .select("payer_name", "file_year", "file_month", F.substring_index("error_message", ":", 1).alias("failure"),
            _time(F.col("event_timestamp")).alias("logged")))

register("last_processed", with_files(f"SELECT max({_WAVE_TIME}) AS last_processed FROM wfiles"))(
    lambda spark, sf: silver_job.last_processed(read_log(spark, batch_lake(spark, sf)["lake"]))
    .select(_time(F.col("last_timestamp")).alias("last_processed")))

register("run_summary", with_files(
    "SELECT count(*) AS files, sum(accepted) AS accepted, sum(quarantined) AS quarantined, "
    f"{O.pct_of('sum(accepted)', 'sum(record_count)')} AS success_pct FROM wfiles"))(
    lambda spark, sf: RP.run_summary(silver_job.latest_log(read_log(spark, batch_lake(spark, sf)["lake"]))))

register("gold_from_files", O.wire_silver_ctes(CFG) + ",\nsilver2 AS (SELECT *, strftime(claim_date, '%Y-%m') "
         "AS year_month FROM wsilver)\n" + MONTHLY_SQL.replace("FROM silver)", "FROM silver2)"))(
    lambda spark, sf: spark.read.parquet(batch_lake(spark, sf)["lake"].monthly).drop("last_updated_timestamp"))

register("funnel_from_files", O.wire_silver_ctes(CFG) + ",\nsilver2 AS (SELECT *, strftime(claim_date, '%Y-%m') "
         "AS year_month FROM wsilver)\n" + FUNNEL_SQL.replace("FROM silver", "FROM silver2"))(
    lambda spark, sf: spark.read.parquet(batch_lake(spark, sf)["lake"].funnel).drop("last_updated_timestamp"))

@register("provider_from_files", O.wire_silver_ctes(CFG) + ",\nsilver2 AS (SELECT * FROM wsilver)"
          + PROVIDER_SQL.replace("FROM silver", "FROM silver2"))
def q_provider_from_files(spark, sf):
    """The provider table as the job wrote it."""
    return provider_out(spark.read.parquet(batch_lake(spark, sf)["lake"].provider)
                        .drop("last_updated_timestamp", "provider_bucket"))


# Both runs' files: read, started and finished events, or one failure.
register("catalog_tables", with_files(
    "SELECT 'bronze' AS layer, 'claims_files' AS table_name, (SELECT count(*) FROM afiles) AS row_count "
    "UNION ALL SELECT 'silver', 'claims', (SELECT count(*) FROM wsilver) "
    "UNION ALL SELECT 'silver', 'claims_quarantine', (SELECT count(*) FROM wquarantine) "
    "UNION ALL SELECT 'silver', 'processing_log', "
    "(SELECT CAST(sum(CASE status WHEN 'completed' THEN 2 ELSE 1 END) AS BIGINT) FROM afiles) "
    "UNION ALL SELECT 'gold', 'claims_monthly_summary', (SELECT count(*) FROM "
    "(SELECT DISTINCT strftime(claim_date, '%Y-%m'), payer_name FROM wsilver)) "
    "UNION ALL SELECT 'gold', 'claims_approval_funnel', (SELECT count(*) FROM "
    "(SELECT DISTINCT strftime(claim_date, '%Y-%m'), payer_name, claim_type FROM wsilver)) "
    "UNION ALL SELECT 'gold', 'provider_performance_metrics', (SELECT count(DISTINCT provider_id) FROM wsilver)"))(
    lambda spark, sf: table_counts(spark, batch_lake(spark, sf)["lake"]))

# ------------------------------------------------------------------ streaming

register("stream_ingest", with_files(f"SELECT {O.CLAIM_COLS} FROM wsilver"))(
    lambda spark, sf: read_silver(spark, stream_lake(spark, sf)).select(*CLAIM_COLUMNS))
