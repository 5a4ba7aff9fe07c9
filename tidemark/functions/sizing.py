"""Stored intermediate tables, and whether one task may hold one of them."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Session setting holding the most rows of a stored table that one task may sort.
SINGLE_TASK_KEY = "spark.tidemark.singleTaskRows"
SINGLE_TASK_DEFAULT = 100_000

#: Session setting by which Spark deletes an action's shuffle files once it has ended.
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_TABLES: list[str] = []


def fits_one_task(stored: DataFrame) -> bool:
    """True when a stored table, hence any group of it, is small enough for one task.

    The rows are counted; of a table written by ``durable`` that reads file footers only.
    """
    limit = int(stored.sparkSession.conf.get(SINGLE_TASK_KEY, str(SINGLE_TASK_DEFAULT)))
    return stored.count() <= limit


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder the cluster names.

    Only a local session without that setting gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(shared)


def scratch_path(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    _TABLES.append(f"{spark.sparkContext.getCheckpointDir()}/{uuid4().hex}")
    return _TABLES[-1]


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables written so far; call it once the results that read them are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    while _TABLES:
        folder = path(_TABLES.pop())
        folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it tables that are written leave no shuffle files behind.

    Otherwise those of every table written so far lie on disk until the driver happens to collect
    its garbage. A table that is written has a plan of its own: no other reads its shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_KEY)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_KEY, before)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the checkpoint folder and read it back.

    Later stages re-read the same rows after an executor is lost instead of computing
    them again, and plans built on the table know its true size, where an estimate
    through joins may be far too large.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
