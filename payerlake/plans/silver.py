"""Silver job: standardise, validate and split every unprocessed file.

Per run, not per file: the new files are grouped by payer and header (the
column names in the file's own order), each group is read by the paths of its
files in one scan (or one a ``files.FILES_A_SCAN`` files), and its columns are
mapped by name, so that reordered and additional columns do no harm.  The
scans' claims are unioned, every rule is evaluated in one projection, and the
flagged rows are stored once on the shared file system; the accepted rows, the
quarantine and the per-file counts are read from that copy.  A file that lacks
a column of its payer's layout, a file without a header, one that has gone and
a file of an unknown payer are logged as failed, each by itself; all others go
through.

Commit protocol: data partitions carry the run id, and the log rows (status
``completed``) are written last.  Readers only see runs whose log says
completed.  A retry with the same id first clears whatever the earlier
attempt left under that id, in any partition; an id that has completed is
refused.  An executor or driver loss at any point never duplicates or
half-publishes rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import DEFAULT, PipelineConfig
from ..operators import standardize as S
from ..operators import dedup, upsert, validate
from ..session import discard, scratch_path, store
from ..sources import files as FS
from ..sources.lake import Lake, read_log, read_registry
from . import keys

LOG_PARTITIONS = ["run_id"]
SILVER_PARTITIONS = ["claim_month", "run_id"]
QUARANTINE_PARTITIONS = ["payer_name", "rejection_day", "run_id"]


def _status_rank():
    """completed > failed > running for events with the same timestamp."""
    out = None
    for status, rank in schemas.LOG_STATUS_RANK.items():
        cond = F.col("status") == status
        out = F.when(cond, rank) if out is None else out.when(cond, rank)
    return out


def latest_log(log: DataFrame) -> DataFrame:
    """Latest state per processing id (append-only events → current row)."""
    ev = log.withColumn("_rank", _status_rank())
    return upsert.latest_state(ev, "processing_id", ["event_timestamp", "_rank"]).drop("_rank")


def latest_by_file(log: DataFrame) -> DataFrame:
    """Latest state per file over all runs (a completed run wins over older failures)."""
    ev = log.withColumn("_rank", _status_rank())
    return upsert.latest_state(ev, "bronze_file_path", ["event_timestamp", "_rank"]).drop("_rank")


def last_processed(log: DataFrame) -> DataFrame:
    """Newest completion time, epoch when nothing completed yet."""
    return log.filter(F.col("status") == "completed").agg(
        F.coalesce(F.max("event_timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp"))
        .alias("last_timestamp"))


def unprocessed_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """Registered files without a completed log entry.

    Unlike a "newer than the last completion" watermark this also retries
    files whose earlier attempt failed.
    """
    done = read_log(spark, lake).filter(F.col("status") == "completed") \
        .select(F.col("bronze_file_path").alias("file_path")).distinct()
    return read_registry(spark, lake).join(done, "file_path", "left_anti")


def read_signature(spark: SparkSession, payer: str, header: list[str], paths: list[str],
                   cfg: PipelineConfig = DEFAULT, gone: list[str] | None = None) -> DataFrame | None:
    """The canonical claims of files of one payer that share a header; None if none of them is left.

    Columns are read by their place in the header and taken by name (whatever its case; of columns
    of the same name the first).  raw_record keeps all columns of the file.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    reader = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
              .option("mode", "PERMISSIVE"))
    raw = FS.read_paths(spark, reader, "csv", paths, gone)
    if raw is None:
        return None
    place = {}
    for i, name in enumerate(header):
        place.setdefault(name.lower(), i)
    wire = {place[w.lower()]: w for w in S.wire_columns(payer)}
    spelled = [wire.get(i, name if name and place[name.lower()] == i else f"{name}_{i}") for i, name in enumerate(header)]
    raw = raw.withColumn("raw_record", F.to_json(F.struct(*(F.col(f"c{i}").alias(n) for i, n in enumerate(spelled)))))
    return S.to_canonical(raw.select(*(F.col(f"c{i}").alias(w) for i, w in wire.items()), "source_file_path", "file_time",
                                   "raw_record"), payer, cfg)


def scans(spark: SparkSession, files: DataFrame, cfg: PipelineConfig = DEFAULT,
          gone: list[str] | None = None) -> Iterator[DataFrame]:
    """One DataFrame of canonical claims a header and block of files; headers are as many as spellings of the layouts."""
    for sig in files.select("payer_name", "header_columns").distinct().orderBy("payer_name", "header_columns").collect():
        same = files.filter((F.col("payer_name") == sig.payer_name)
                            & (F.col("header_columns") == F.array(*map(F.lit, sig.header_columns))))
        for paths in FS.path_blocks(same):
            claims = read_signature(spark, sig.payer_name, sig.header_columns, paths, cfg, gone)
            if claims is not None:
                yield claims


def _processing_id(run_id: str):
    return F.concat_ws("_", F.lit(run_id), F.col("payer_name"), F.sha2(F.col("bronze_file_path"), 256))


def log_events(files: DataFrame, run_id: str, status: str, ts: _dt.datetime, day: _dt.date | None = None,
               counts: DataFrame | None = None, error: Column | str | None = None) -> DataFrame:
    """One log event per file; ``counts`` (per bronze_file_path) fills the
    record counts of a completed event, a file without rows counts 0."""
    error = error if isinstance(error, Column) else F.lit(error)
    base = files.select(F.col("file_path").alias("bronze_file_path"), "payer_name",
                        error.cast("string").alias("error_message"))
    metrics = ("records_read", "records_accepted", "records_quarantined")
    if counts is not None:
        base = base.join(counts, "bronze_file_path", "left")
        vals = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in metrics]
    else:
        vals = [F.lit(None).cast("bigint").alias(c) for c in metrics]
    return base.select(
        _processing_id(run_id).alias("processing_id"), "bronze_file_path", "payer_name",
        F.lit(ts).cast("timestamp").alias("event_timestamp"), F.lit(status).alias("status"),
        *vals, "error_message", F.lit(day).cast("date").alias("processing_date"), F.lit(run_id).alias("run_id"))


def commit_log(lake: Lake, events: DataFrame) -> None:
    """The commit point of a run: its log partition with the completed rows."""
    upsert.overwrite_partitions(events, lake.log, LOG_PARTITIONS)


class RunIdUsed(ValueError):
    """The run id names a completed run; writing under it would replace that run."""


def run_completed(spark: SparkSession, lake: Lake, run_id: str) -> bool:
    log = read_log(spark, lake).filter((F.col("run_id") == run_id) & (F.col("status") == "completed"))
    return not log.isEmpty()


def refuse_reason() -> Column:
    """Why a registered file cannot be read; NULL if it can."""
    payer, header = F.col("payer_name"), F.col("header_columns")
    names = F.transform(header, F.lower)
    missing = None
    for p in S.PAYERS:
        wanted = F.array(*map(F.lit, S.wire_columns(p)))
        lacks = F.filter(wanted, lambda c: ~F.array_contains(names, F.lower(c)))
        missing = F.when(payer == p, lacks) if missing is None else missing.when(payer == p, lacks)
    return (F.when(payer.isNull() | ~payer.isin(list(S.PAYERS)), F.concat(F.lit("Unknown payer: "), F.coalesce(payer, F.lit("none"))))
            .when(header.isNull(), F.lit("No header: the file has no line"))
            .when(F.size(missing) > 0, F.concat(F.lit("Columns missing from the header: "), F.array_join(missing, ", "))))


# Scans that are stored together by one job.
SCANS_A_JOB = 16


def flag_scan(claims: DataFrame, number: int, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One scan's claims with their reasons and what only the scan knows.

    The wire row is kept for rejected claims alone; with ``cfg.dedup`` for all, since accepted
    ones may still be rejected as duplicates, and with the row ids and file times that decide it.
    """
    flagged = validate.with_reasons(claims, cfg)
    if cfg.dedup:
        return flagged.withColumn("row_id", F.struct(F.lit(number).alias("scan"), F.monotonically_increasing_id().alias("row")))
    return (flagged.drop("file_time")
            .withColumn("raw_record", F.when(F.size("rejection_reasons") > 0, F.col("raw_record"))))


def of_run(flagged: DataFrame, run_id: str, run_ts: _dt.datetime, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Stored claims with the columns that the run and the claim date give."""
    return (flagged.withColumn("ingestion_timestamp", F.lit(run_ts).cast("timestamp"))
            .withColumn("processing_date", F.lit(cfg.as_of))
            .withColumn("run_id", F.lit(run_id))
            .withColumn("claim_month", F.date_format("claim_date", "yyyy-MM")))


def flag_claims(spark: SparkSession, claims: Iterator[DataFrame], cfg: PipelineConfig = DEFAULT) -> str | None:
    """Validate the scans' claims and store them with their reasons; the folder they are in, or None without a scan."""
    out, held, number = scratch_path(spark, "flagged"), [], 0

    def write() -> None:
        rows = held[0]
        for more in held[1:]:
            rows = rows.unionByName(more)
        rows.write.mode("append").parquet(out)
        held.clear()

    for number, scan in enumerate(claims, 1):
        held.append(flag_scan(scan, number, cfg))
        if len(held) == SCANS_A_JOB:
            write()
    if held:
        write()
    return out if number else None


def mark_duplicates(spark: SparkSession, lake: Lake, flagged: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """``flagged`` with the reason DUPLICATE_CLAIM on accepted rows whose key is published or comes again."""
    good = validate.accepted(flagged).select(*dedup.KEYS, "row_id", F.struct("file_time", "source_file_path").alias("newest"))
    again = store(dedup.duplicate_rows(good, keys.published(spark, lake, good, cfg)), "duplicates")
    return (flagged.join(again.withColumn("again", F.lit(True)), "row_id", "left")
            .withColumn("rejection_reasons", F.when(F.col("again"), F.array(F.lit(f"{dedup.REASON}: claim_id")))
                        .otherwise(F.col("rejection_reasons"))).drop("again"))


def publish(spark: SparkSession, lake: Lake, flagged: DataFrame, files: DataFrame, refused: DataFrame,
            run_id: str, run_ts: _dt.datetime, cfg: PipelineConfig = DEFAULT) -> None:
    """Publish one batch of flagged claims with its log."""
    day = cfg.as_of
    good = validate.accepted(flagged).select(*schemas.SILVER_CLAIMS.fieldNames())
    upsert.overwrite_partitions(good, lake.silver_claims, SILVER_PARTITIONS)
    bad = (validate.quarantine_projection(validate.quarantined(flagged), F.lit(run_ts).cast("timestamp"))
           .withColumn("run_id", F.lit(run_id))
           .withColumn("rejection_day", F.lit(run_ts.date().isoformat())))
    # Of one run these partitions are as many as payers, so each task writes its own few files: wide rows, no shuffle.
    upsert.overwrite_partitions(bad.select(*schemas.QUARANTINE.fieldNames()), lake.quarantine,
                                QUARANTINE_PARTITIONS, cluster=False)
    counts = (flagged.groupBy(F.col("source_file_path").alias("bronze_file_path"))
              .agg(F.count(F.lit(1)).alias("records_read"),
                   F.count_if(F.size("rejection_reasons") == 0).alias("records_accepted"),
                   F.count_if(F.size("rejection_reasons") > 0).alias("records_quarantined")))
    if cfg.dedup:
        keys.add_part(lake, good.select(*dedup.KEYS), spark.createDataFrame([(run_id,)], "run_id string"), cfg)
    commit_log(lake, log_events(files, run_id, "running", run_ts, day)
               .unionByName(log_events(files, run_id, "completed", run_ts, day, counts)).unionByName(refused))


def process_files(spark: SparkSession, lake: Lake, registered: DataFrame, run_id: str,
                  run_ts: _dt.datetime, cfg: PipelineConfig = DEFAULT) -> dict:
    """Publish every readable file of ``registered`` (registry rows) in one run;
    log the others, and all of them if the run itself fails, as failed."""
    if run_completed(spark, lake, run_id):
        raise RunIdUsed(f"run {run_id} has completed; choose another id")
    # A copy: the rows must not be recomputed from the log while this run writes its own part of it.
    todo = store(registered.withColumn("refused", refuse_reason()), "todo")
    files, broken = todo.filter("refused IS NULL"), todo.filter("refused IS NOT NULL")
    n, failed = todo.count(), broken.count()
    if not n:
        return {"run_id": run_id, "files": 0, "failed": 0, "unknown_payers": [], "error": None}
    for path in (lake.silver_claims, lake.quarantine):
        upsert.drop_run(spark, path, run_id)
    refused = log_events(broken, run_id, "failed", run_ts, error=F.col("refused"))
    # 'running' events first: an in-flight (or crashed) run is visible in the log.
    commit_log(lake, log_events(files, run_id, "running", run_ts).unionByName(refused))
    error = None
    if failed < n:
        try:
            gone: list[str] = []
            folder = flag_claims(spark, scans(spark, files, cfg, gone), cfg)
            if gone:
                # Deleted after they were registered: few, or the landing folder is being emptied.
                lost = spark.createDataFrame([(p,) for p in gone], "p string")
                away = FS.plain_path(F.col("file_path")) == F.col("p")
                refused = refused.unionByName(log_events(files.join(lost, away, "left_semi"), run_id, "failed", run_ts,
                                                         error="File not found: it has gone since it was registered"))
                files, failed = files.join(lost, away, "left_anti"), failed + len(gone)
            if folder:
                flagged = of_run(spark.read.parquet(folder), run_id, run_ts, cfg)
                if cfg.dedup:
                    flagged = mark_duplicates(spark, lake, flagged, cfg)
                publish(spark, lake, flagged, files, refused, run_id, run_ts, cfg)
                discard(spark, folder)
            else:
                commit_log(lake, refused)
        except Exception as exc:  # noqa: BLE001 - logged per file, like the original
            # Nothing of this run is visible (no completed log rows); record
            # the failure per file so the files are retried by the next run.
            error, failed = f"{type(exc).__name__}: {exc}", n
            commit_log(lake, log_events(files, run_id, "failed", run_ts, error=error).unionByName(refused))
    unknown = [r.payer_name for r in broken.filter(F.col("refused").startswith("Unknown payer"))
               .select("payer_name").distinct().collect()]
    return {"run_id": run_id, "files": n, "failed": failed, "unknown_payers": unknown, "error": error}


def run_silver(spark: SparkSession, lake: Lake, run_id: str, run_ts: _dt.datetime,
               cfg: PipelineConfig = DEFAULT) -> dict:
    return process_files(spark, lake, unprocessed_files(spark, lake), run_id, run_ts, cfg)
