"""Table maintenance on plain parquet: replace slices, replace keys, latest state.

* ``overwrite_partitions`` – dynamic partition overwrite: only the partitions
  present in the new data are replaced, in one write (the original did a
  DELETE then an append per month, i.e. two commits and a loop).
* ``replace_keys`` – rows of ``new`` replace rows of ``current`` with the same
  key: anti-join the current table against the new keys and union the new
  rows.  The join runs on the key, so Spark plans a shuffle (or, when AQE
  measures the key side as small, a broadcast) – one code path for any
  number of keys.
* ``latest_state`` – the newest event per key of an append-only log, as one
  hash aggregate with ``max_by`` (partial aggregation map-side, so a key with
  many events is combined before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped


def rebalance(df: DataFrame, cols: list[str]) -> DataFrame:
    """Shuffle rows by the partition columns with the REBALANCE hint: AQE
    coalesces small partitions (few files per partition value) and splits an
    oversized one into several tasks (a hot month is written in parallel)."""
    return df.hint("rebalance", *cols) if cols else df


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str],
                         fmt: str = "parquet", cluster: bool = True) -> None:
    """Replace exactly the partitions present in ``df`` (one write, no DELETE)."""
    if cluster:
        df = rebalance(df, partition_cols)
    with shuffles_dropped(df.sparkSession):
        (df.write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_cols)
           .format(fmt).save(path))


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None,
           fmt: str = "parquet") -> None:
    w = rebalance(df, partition_cols or []).write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    with shuffles_dropped(df.sparkSession):
        w.save(path)


def replace_keys(current: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    keep = current.join(new.select(*keys).distinct(), keys, "left_anti")
    return keep.unionByName(new.select(*current.columns))


def latest_state(events: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the event with the greatest (order_cols...) tuple."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in events.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    latest = F.max_by(F.struct(*[F.col(c) for c in payload]), order)
    return events.groupBy(*keys).agg(latest.alias("_s")).select(*keys, "_s.*")


def partition_values(df: DataFrame, col: str) -> list:
    """Distinct values of a partition column (a partition list, small by
    construction – e.g. months); collect it once before deleting anything."""
    return [r[0] for r in df.select(col).distinct().collect()]


def drop_partitions(spark, values: list, path: str, col: str) -> list[str]:
    """Delete the ``col=<value>`` partition folders – the parquet equivalent of
    ``ALTER TABLE … DROP PARTITION``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = []
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{col}={v}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            dropped.append(v)
    return dropped


def clear(spark, path: str) -> None:
    """Delete a whole table; one that is not there is fine."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_run(spark, path: str, run_id: str) -> None:
    """Delete every ``run_id=<run_id>`` folder of a table partitioned by it last,
    whatever the partitions above hold."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for depth in ("*", "*/*"):
        for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{depth}/run_id={run_id}")) or []:
            fs.delete(found.getPath(), True)
