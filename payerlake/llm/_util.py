"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# ASCII white space, as the contracts define words: blank and \t \n \v \f \r.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def set_if_unset(spark: SparkSession, key: str, value: str) -> None:
    """Give a session option a value unless the session already names one."""
    if key not in spark.conf.getAll:
        spark.conf.set(key, value)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few hundred texts, so that long ones do not add up in a worker."""
    set_if_unset(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "400")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame) -> DataFrame:
    """``df`` in at most four partitions a core, for a table of a few numbers a row whose last step is cheap.

    On a local file system each written file starts two processes, forked off the executor.
    """
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About four times ``rows`` rows of ``df``, by a hash of the key; all of a smaller table.

    A following ``orderBy().limit(rows)`` then reads as little at any size of the table.
    """
    share = min(1.0, 4 * rows / max(df.count(), 1))
    return df.filter(F.pmod(F.xxhash64(F.lit(29), F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30)))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
