"""Table sinks on plain parquet folders.

Rewrites are computed into a staged copy in the shared checkpoint folder first. Nothing reads the files it
is overwriting, a job that fails while computing leaves the old rows in place, and if the closing plain
copy is cut off the staged rows are still there to copy again; once it is done they are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import schemas
from ..functions.timing import in_chunks
from ..operators import rows
from ..session import staging
from ..streaming.jobs import is_terminal


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def replace(df: DataFrame, path: str, part: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*part) if part else w).parquet(path)


def append_counted(df: DataFrame, path: str, part: list[str] | None = None) -> int:
    """Append and return how many rows went in; counted while writing, not by two table counts."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (w.partitionBy(*part) if part else w).parquet(path)
    return seen.get["n"]


def publish(df: DataFrame, path: str, part: list[str] | None = None) -> DataFrame:
    """Replace a table's rows; its columns stay, new ones are added, common ones are cast to its types.

    With ``part`` only the partitions present in ``df`` are replaced.
    """
    spark = df.sparkSession
    old = existing(spark, path)
    schema = df.schema if old is None else rows.evolve(old, df)
    with staging(rows.align(df, schema), "publish") as stage:
        if part:
            stage.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(path)
        else:
            replace(stage, path)
    return spark.read.schema(schema).parquet(path)


def land_product(df: DataFrame, root: str, product: str, start: str, end: str, span: int = 30) -> None:
    """Write product rows of one run under ``dataset=/state=/chunk_start=``.

    Chunks of the run replace earlier copies of themselves; other states and chunks stay. A chunk of a
    state is spread by id, so a busy chunk does not end in one task.
    """
    placed = in_chunks(df, "valid", start, end, span).drop("chunk").withColumn("dataset", F.lit(product))
    keys = ["dataset", "state", "chunk_start"]
    spread = placed.repartition(*keys, F.pmod(F.xxhash64("id"), F.lit(16)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)


def upsert_into(path: str, updates: DataFrame, keys: list[str], version: Column, now: Column | None = None,
                part: str | None = None) -> None:
    """Apply the last update of every key to the table at ``path``.

    With ``part``, a column that a key never changes, only partitions the updates touch are read and
    rewritten.
    """
    spark = updates.sparkSession
    old = existing(spark, path)
    if old is None:
        fresh = rows.pick_per_key(updates, [F.col(k) for k in keys], version, last=True)
        if now is not None:
            fresh = fresh.withColumns({"created_at": now, "updated_at": now})
        replace(fresh, path, [part] if part else None)
        return
    if part:
        old = old.join(updates.select(part).distinct(), part, "left_semi")
    with staging(rows.upsert(old, updates, keys, version, now), "upsert") as merged:
        if part:
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
        else:
            replace(merged, path)


def insert_absent(path: str, new: DataFrame, keys: list[str], order: Column) -> int:
    """Append rows whose key the table lacks; null keys count as equal. Returns the rows added."""
    old = existing(new.sparkSession, path)
    if old is None:
        return append_counted(rows.pick_per_key(new, [F.col(k) for k in keys], order), path)
    with staging(rows.absent_rows(old, new, keys, order), "absent") as fresh:
        return append_counted(fresh, path)


def update_runs(path: str, updates: DataFrame, now: Column) -> None:
    """Submit bookkeeping: blank values keep the old ones, the first submit time stays, errors clear."""
    runs = updates.sparkSession.read.parquet(path)
    out = rows.coalesce_update(runs, updates, "run_id", ["batch_job_id", "webhook_url", "api_base"],
                               {"submitted_at": now}, cleared=("last_error",))
    with staging(out, "runs") as stage:
        replace(stage, path)


def log_step(spark: SparkSession, path: str, ts: str, state: str, step: str, status: str, note: str = "") -> None:
    row = spark.createDataFrame([(ts, state, step, status, note)], "ts string, state string, step string, status string, note string")
    rows.align(row.withColumn("note", F.substring("note", 1, 2000)), _schema(spark, schemas.RUN_LOG)) \
        .write.mode("append").parquet(path)


def store_traces(events: DataFrame, addresses_of_jobs: DataFrame, path: str) -> int:
    """Add results of finished jobs as ``(address_id, batch_job_id, status, result, completed_at)``.

    Events of jobs that still run are left out; an address and job that the table has already, or that comes again in
    ``events``, is not added twice (the earliest stays). Returns the rows added.
    """
    done = events.where(is_terminal()).join(addresses_of_jobs, "job_id").select(
        "address_id", F.col("job_id").alias("batch_job_id"), "status", F.col("payload").alias("result"),
        F.col("received_at").alias("completed_at"))
    traces = rows.align(done, _schema(events.sparkSession, schemas.TRACES))
    return insert_absent(path, traces, ["address_id", "batch_job_id"], F.col("completed_at"))


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema
