"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Spark's own removal of shuffle files once the query that made them has ended.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join may be split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(app_name: str = "halfstar", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this
    machine; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="halfstar-")
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def checkpoint_dir(spark: SparkSession) -> None:
    """Point RDD checkpoints (used by ALS to cut its lineage) at the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{scratch_dir(spark)}/rdd")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/halfstar/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within this block a query's shuffle files go when it ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def discard(*written: DataFrame) -> None:
    """Delete tables that ``materialise`` has written and nobody reads any more."""
    for df in written:
        path = getattr(df, "scratch_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``discard`` deletes the table.

    The written table survives executor loss, cuts the lineage, is read with
    column pruning and gives the optimizer a true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


ROWS_PER_TASK, MOST_ROWS_PER_TASK = 20_000, 1_000_000


def packed(written: DataFrame) -> DataFrame:
    """Read a small written table in few partitions.

    For inputs of iterative solvers, which pass over the rows hundreds of times
    and pay per task each time: no more partitions than the cores can use, unless
    they would grow too large.
    """
    return written.coalesce(tasks_for(written.count(), written.sparkSession.sparkContext.defaultParallelism))


def tasks_for(rows: int, cores: int) -> int:
    return max(1, min(ceil(rows / ROWS_PER_TASK), 2 * cores), ceil(rows / MOST_ROWS_PER_TASK))
