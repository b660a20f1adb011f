"""Folders that every executor can reach, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cohortloom.sources.files import qualify

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_made: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Shared folder named by the session.

    Where the session names none, a local-mode session gets a temporary folder
    of its own; on a cluster that would not be shared, so it is refused.
    """
    configured = spark.conf.get(SETTING, None)
    if configured:
        return qualify(spark, configured)
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = qualify(spark, tempfile.mkdtemp(prefix="cohortloom-"))
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder; never handed out twice."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is put into the shared folder inside the block when it ends.

    For jobs that write their result elsewhere: frames made inside must not be used after.
    """
    before = len(_made)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _made[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)
        del _made[before:]


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Give iterative Spark ML fits a checkpoint folder when none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    Cuts the lineage, survives lost executors, and unlike a block cache keeps
    column pruning, filters and size statistics for the readers that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
