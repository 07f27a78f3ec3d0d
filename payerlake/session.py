"""Spark session helpers.

The library never creates machine-local scratch space on its own when it
runs on a cluster: all intermediate tables go under the shared folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests, the bench) do we point it at a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; every one is a plain Spark option.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast decisions use measured sizes (AQE); 32 MB is a
    # conservative ceiling for a side that is not known to be tiny.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Tables and intermediate copies of them are most of what a job keeps on disk.
    "spark.sql.parquet.compression.codec": "zstd",
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "payerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


# What results depend on, whatever the session says.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set what results depend on; of the rest only what the session leaves unset."""
    given = spark.conf.getAll
    for k, v in SCALE_CONF.items():
        if k not in given and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch root: the cluster's ``spark.checkpoint.dir``.

    When it is unset in local mode (tests, bench) a fresh folder is created once
    and registered as the checkpoint directory of this context.  On a cluster a
    machine-local folder would lose rows, so there the setting is required.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="payerlake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within delete their shuffle files as soon as they have ended.

    Otherwise these stay until the driver's JVM happens to collect the plan, which on a cluster may be
    after the last of a job's writes.  A write plans its own shuffles, so nothing reads them again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared scratch root and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared scratch root that nothing reads any more; other paths are refused."""
    if not path.startswith(checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the scratch root")
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can look at a local path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Hadoop-filesystem existence check (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))
