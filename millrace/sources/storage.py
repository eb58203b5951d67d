"""Intermediate data on storage that every executor can reach.

Intermediate results are written as parquet instead of being cached: they outlive lost executors,
and later passes read only the columns they need.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Paths handed out and not yet deleted: one list for the process, one more per open scope.
_scopes: list[list[str]] = [[]]
_local_dirs: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate data: the session's ``spark.checkpoint.dir``.

    Only a session on a local master that names no folder gets a temporary one; on a cluster a
    missing setting is an error, because executors could not share a machine-local folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        base = configured.rstrip("/")
    elif context.master.startswith("local"):
        if not _local_dirs:
            _local_dirs.append(tempfile.mkdtemp(prefix="millrace-"))
            atexit.register(shutil.rmtree, _local_dirs[0], ignore_errors=True)
        base = "file:" + _local_dirs[0]
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path for intermediate data below the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    _scopes[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that owns it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of what was written."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What jobs inside the block have shuffled leaves the disk when each of them ends.

    Otherwise it stays until the driver happens to collect its garbage. For blocks that end in staged
    data: a frame that was made inside and not staged would shuffle anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Delete the intermediate data of this process, once no frame that reads it is needed."""
    while _scopes[-1]:
        delete_path(spark, _scopes[-1].pop())


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Delete intermediate data that came about inside the block when the block ends.

    For blocks that end in written tables, so that no frame has to read the data any more.
    """
    _scopes.append([])
    try:
        yield
    finally:
        release(spark)
        _scopes.pop()
