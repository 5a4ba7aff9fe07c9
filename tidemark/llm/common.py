"""Shared helpers: tables in the shared folder, reading, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_TABLES: list[str] = []
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) that names none gets a scratch folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL[app]


def new_table(spark: SparkSession) -> str:
    """Path of a table that does not exist yet, below the shared folder."""
    path = f"{shared_folder(spark)}/table-{uuid4().hex}"
    _TABLES.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors
    and do not compute it again. ``drop_tables`` removes the files."""
    path = new_table(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote; call it once the results are written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    while _TABLES:
        path = hadoop(_TABLES.pop())
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Session setting for the rows that Spark hands to Python at once, and the most for documents.
BATCH_ROWS_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def document_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to hand documents to Python in batches of at most ``BATCH_ROWS``.

    The default suits narrow rows; that many whole texts would fill an executor's memory.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_ROWS_KEY)) <= BATCH_ROWS:
        conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))
    return df


def give_back() -> None:
    """Return what a finished task has freed to the system. A Python worker waits for more tasks
    and would hold that memory beside those of other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def held_out(key: str | Column = "doc_id") -> Column:
    """True for the fifth of all documents that no model learns from."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (u, v) with ``component``, the smallest node reachable from them.

    Alternating large-star and small-star steps until nothing changes: a chain of n nodes
    needs about log n rounds, a star one. Minima are partial aggregates, so a node with many
    edges is not gathered in a task; Spark splits its rows in the join. Loops and rows with
    a null are left out; equal edges count once.
    """
    pairs = edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    low, high = F.least("u", "v"), F.greatest("u", "v")
    now = stored(pairs.select(high.alias("u"), low.alias("v")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            linked.select("u", F.col("m").alias("v"))
        )
        now = stored(small.where("u <> v").distinct())
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if mark == state:
            break
        mark = state
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
