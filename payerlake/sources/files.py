"""Raw payer files: list, scan, describe – and write test feeds.

A file is known by its canonical URI (``_metadata.file_path``) in every table
and every job.  Listing uses the ``binaryFile`` source without its content
column, so it reads file metadata only (a header-only CSV is still seen).
Files are read by their own paths, ``FILES_A_SCAN`` of them in a scan: a new
file in a folder of many is the only one that is opened, and the driver holds
the paths of one scan at a time.  The path layout is Hive style::

    <root>/provider=<payer>/year=<YYYY>/month=<M>/batch=<n>/<file>.csv

and payer / year / month are parsed out of the path with ``regexp_extract``.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..operators import standardize as S
from ..session import exists, scratch_path, shuffles_dropped

FILES_A_SCAN = 5000
# Payer files: plain, or packed by gzip (read whole by one task, so a packed file should not be huge).
CSV_FILES = "*.{csv,csv.gz}"
SCHEMA_VERSION = "v1"
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def listing(files: DataFrame) -> DataFrame:
    """Name, size and time of each row's file, from a (batch or streaming) ``binaryFile`` read."""
    return files.select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size_bytes"),
                        F.col("_metadata.file_modification_time").alias("modification_time"))


def list_files(spark: SparkSession, root: str, modified_after: _dt.datetime | None = None) -> DataFrame:
    """The CSV files below ``root``; with ``modified_after`` (UTC) only those written later."""
    reader = (spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES)
              .option("recursiveFileLookup", "true"))
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return listing(reader.load(root))


def plain_path(uri: Column) -> Column:
    """The path behind a file URI: blanks, percent signs and so on decoded."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def path_blocks(files: DataFrame, size: int | None = None) -> Iterator[list[str]]:
    """The paths of the files (column file_path), ``FILES_A_SCAN`` at a time."""
    size, block = size or FILES_A_SCAN, []
    paths = files.select(plain_path(F.col("file_path")).alias("p")).distinct()
    for row in paths.toLocalIterator():
        block.append(row.p)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def literal(path: str) -> str:
    """A path that the reader's glob patterns match as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_paths(spark: SparkSession, reader, fmt: str, paths: list[str], gone: list[str] | None = None) -> DataFrame | None:
    """Rows of exactly the given files, with their URI as source_file_path and its file_time; None if none is left.

    Files that have gone since they were listed are left out, and added to ``gone``.
    """
    reader = reader.option("recursiveFileLookup", "true").format(fmt)
    try:
        rows = reader.load([literal(p) for p in paths])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        left = [p for p in paths if exists(spark, p)]
        if gone is not None:
            gone += sorted(set(paths) - set(left))
        if not left:
            return None
        rows = reader.load([literal(p) for p in left])
    return rows.select("*", F.col("_metadata.file_path").alias("source_file_path"),
                       F.col("_metadata.file_modification_time").alias("file_time"),
                       F.col("_metadata.file_block_start").alias("block_start"))


def header_names(line: Column) -> Column:
    """The column names of a header line: split at commas outside quotes, without quotes, blanks and byte order mark."""
    parts = F.split(F.regexp_replace(line, "^\ufeff", ""), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', "")))


SCANNED = "file_path string, record_count long, header_columns array<string>"


def scan_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """file_path, record_count (lines with text, without the header) and header_columns of each file.

    One aggregate over the lines of each block of files.  header_columns are the names in the
    first line with text; a file without any line, or one that cannot be read, has no row.
    """
    out = scratch_path(spark, "scanned")
    spark.createDataFrame([], SCANNED).write.parquet(out)
    for paths in path_blocks(files):
        lines = read_paths(spark, spark.read.option("ignoreCorruptFiles", "true"), "text", paths)
        if lines is None:
            continue
        lines = lines.withColumn("line", F.monotonically_increasing_id())
        # A character that is no quote, mark or blank.
        some = F.col("value").rlike("[^\"\ufeff ]")
        first = F.min_by("value", F.when((F.col("block_start") == 0) & some, F.col("line")))
        per_file = lines.groupBy("source_file_path").agg(F.count_if(some).alias("n"), first.alias("first"))
        with shuffles_dropped(spark):
            (per_file.select(F.col("source_file_path").alias("file_path"),
                             F.greatest(F.col("n") - 1, F.lit(0)).alias("record_count"),
                             header_names(F.col("first")).alias("header_columns"))
             .write.mode("append").parquet(out))
    return spark.read.schema(SCANNED).parquet(out)


def path_part(path: Column, key: str) -> Column:
    return F.regexp_extract(path, f"{key}=([^/]+)", 1)


def describe(files: DataFrame) -> DataFrame:
    """Registry columns derivable from the path alone."""
    p = plain_path(F.col("file_path"))
    payer = path_part(p, "provider")
    return files.select(
        "file_path",
        F.regexp_extract(p, r"([^/]+)$", 1).alias("file_name"),
        F.when(payer != "", payer).alias("payer_name"),
        path_part(p, "year").try_cast("int").alias("file_year"),
        path_part(p, "month").try_cast("int").alias("file_month"),
        "file_size_bytes")


# ------------------------------------------------------------------ test feeds

def file_batch(cfg: PipelineConfig = DEFAULT) -> Column:
    """Optional split of a payer-month into ``files_per_month`` folders by a
    hash of the claim id (60 bits of its md5); one folder needs no hash."""
    if cfg.files_per_month == 1:
        return F.when(F.col("claim_id").isNotNull(), F.lit(0).cast("bigint"))
    bits = F.conv(F.substring(F.md5(F.col("claim_id")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(cfg.files_per_month))


def write_feeds(claims: DataFrame, root: str, cfg: PipelineConfig = DEFAULT,
                payers=S.PAYERS, arrange: dict | None = None) -> None:
    """Write canonical claims as the payers' CSV files under ``root``.

    ``arrange`` maps a payer to a function that reorders or adds columns of its feed.

    Rows are rebalanced by the leaf keys, typed as they are, and rendered
    afterwards: a leaf below the advisory partition size is written by one task
    (one file), a larger one is split by AQE over several tasks.  Files are packed
    by gzip: as plain text they would take several times the room of the tables.
    """
    keys = ["year", "month", "batch"]
    for payer in payers:
        part = claims.filter(F.col("payer_name") == payer).select(
            "*", F.year("claim_date").alias("year"), F.month("claim_date").alias("month"),
            file_batch(cfg).alias("batch")).hint("rebalance", *keys)
        feed = (arrange or {}).get(payer, lambda df: df)(S.render_feed(part, payer, keep=keys))
        with shuffles_dropped(claims.sparkSession):
            (feed.write.mode("append").option("header", True).option("compression", "gzip")
                 .partitionBy(*keys).csv(f"{root}/provider={payer}"))
