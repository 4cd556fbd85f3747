"""Structured Streaming jobs over landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.binding import let
from ..operators import rows
from ..session import staged
from ..sinks import tables
from ..sources import addresses, geojson
from . import jobs, keyed

_RECORD = "received_at timestamp_ntz, headers map<string,string>, body string"


def read_events(spark: SparkSession, folder: str, per_trigger: int | None = None) -> DataFrame:
    """Landed event records, one JSON text per line: ``received_at, headers, body``.

    The record's own time is used, so a replay gives the same rows. A line that is not such a record is
    kept as the body.
    """
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    lines = reader.load(folder)
    rec = let(F.from_json("value", _RECORD), lambda r: F.struct(
        r["received_at"].alias("received_at"), r["headers"].alias("headers"),
        F.coalesce(r["body"], F.col("value")).alias("body")))
    return lines.select(F.inline(F.array(rec)))


def parsed_events(raw: DataFrame) -> DataFrame:
    return jobs.parse_events(raw, keep=("headers",))


def without_repeats(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries of one payload that arrive within ``delay``."""
    timed = events.withColumn("event_time", F.col("received_at").cast("timestamp"))
    return (timed.withWatermark("event_time", delay).withColumn("_h", F.xxhash64("payload", "received_at"))
            .dropDuplicatesWithinWatermark(["_h"]).drop("_h", "event_time"))


def store_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append parsed events to a parquet table, each landed file once, then stop."""
    return (events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def keep_latest_status(events: DataFrame, path: str, checkpoint: str, keep_hours: int | None = None) -> StreamingQuery:
    """Append every change of a job's newest status to a table that ``current_status`` reads; the newest one is keyed state."""
    return (keyed.status_changes(events, keep_hours).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def current_status(spark: SparkSession, path: str) -> DataFrame:
    """Latest status per job of a table of changes."""
    found = tables.existing(spark, path)
    if found is None:
        raise LookupError(f"no status table at {path}")
    return rows.latest_per(found, "job_id", F.struct("received_at", "status"))


def overdue_stream(events: DataFrame, seconds: int = 300, delay: str = "1 minute", keep_seconds: int = 86_400) -> DataFrame:
    """See ``keyed.overdue_jobs``."""
    return keyed.overdue_jobs(events, seconds, delay, keep_seconds)


_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_addresses(spark: SparkSession, folder: str, path: str, checkpoint: str, log: str | None = None,
                     per_trigger: int = 1_000, names: str = geojson.NAMES) -> StreamingQuery:
    """Load new GeoJSON documents, once each, whatever their size and layout (see ``sources.geojson``).

    The stream lists files, without their content; a micro-batch reads them block by block. It owns one partition of the table
    and one of the import log ``log`` (default: ``path`` + ``_log``), so repeating it replaces its own rows only. The log
    has one row per file: the features it holds and the rows they gave, both 0 for an empty or broken one.
    """
    files = (spark.readStream.format("binaryFile").schema(_LISTED).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", names).load(folder)
             .select(F.col("path").alias("file_path"), "length"))

    def load(batch: DataFrame, batch_id: int) -> None:
        found = geojson.features(geojson.layout(batch.sparkSession, batch))
        parsed = staged(addresses.address_rows(found, keep=("file_path",)), "addresses")
        put = lambda df, to: (df.withColumn("load_id", F.lit(batch_id)).write.mode("overwrite")
                              .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(to))
        put(parsed.where(addresses.usable()), path)
        counts = parsed.groupBy("file_path").agg(F.count("*").alias("num_features"),
                                                 F.count_if(addresses.usable()).alias("num_rows"))
        put(batch.select("file_path").join(counts, "file_path", "left").select(
            "file_path", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("num_features", "num_rows")],
            F.current_timestamp().cast("timestamp_ntz").alias("imported_at")), log or f"{path.rstrip('/')}_log")

    return (files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
