"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..operators import rows
from ..plans import maps
from . import tables


def write_csv(df: DataFrame, path: str, at_most: int | None = None) -> None:
    """CSV with a header in every file, also when there are no rows; nested columns as JSON text.

    With ``at_most`` the result is one file; more rows than that are an error, as one task writes them.
    """
    flat = df.select(*text.flat_text(df))
    if at_most is not None:
        if flat.limit(at_most + 1).count() > at_most:
            raise ValueError(f"more than {at_most} rows for one file")
        flat = flat.coalesce(1)
    flat.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_features(df: DataFrame, path: str, geometry, properties: list[str]) -> None:
    """Line-delimited GeoJSON features."""
    df.select(maps.feature(geometry, properties).alias("value")).write.mode("overwrite").text(path)


def export_targets(targets: DataFrame, path: str, runs_path: str, run: dict, at_most: int = 100_000) -> None:
    """Write a target list and its own run row (``run`` holds run_id, state, created_at)."""
    write_csv(targets, path, at_most)
    spark = targets.sparkSession
    row = spark.createDataFrame([(run["run_id"], run["state"], path, run["created_at"])],
                                "run_id long, state string, output_path string, created_at string")
    rows.align(row, tables._schema(spark, schemas.RUNS)).write.mode("append").parquet(runs_path)


def export_leads(leads: DataFrame, prefix: str, at_most: int = 100_000) -> None:
    """The full list with diagnostics, and the short list for the vendor."""
    write_csv(leads, f"{prefix}_full.csv", at_most)
    write_csv(leads.select("street", "city", "state", "zip"), f"{prefix}_vendor.csv", at_most)


def split_requests(batches: DataFrame, path: str) -> None:
    """One JSON payload per line, kept with its batch number; nothing is sent."""
    batches.select(F.to_json(F.struct("batch_id", "num_rows", "payload")).alias("value")).write.mode("overwrite").text(path)
