"""Session settings and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join partitions even if a later grouping must shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "stormgrid", master: str | None = None, **extra) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is set only where the session names none (tests on one machine).
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if named is None and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="stormgrid-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage is cut and an executor loss costs no recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def for_session(spark: SparkSession, path: str) -> str:
    """``path``, to be removed when the application ends: its frames read it until then."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Unlike a checkpoint the result is columnar, pruned on read, and has file statistics, so the
    planner knows its real size when it decides about broadcasting. The table goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    for_session(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged copy for the time of one rewrite: removed when the block ends well, left in place when it fails."""
    copy = staged(df, name)
    path = os.path.dirname(copy.inputFiles()[0]) if copy.inputFiles() else None
    yield copy
    if path:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly per-row work on a scan with few splits (one row group, gzip text).

    A scan that already has a split per core, as any large table does, is left alone: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows that each stand for much work, dealt to all cores whatever the splits: a small file is few splits, a row group is one task."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)
