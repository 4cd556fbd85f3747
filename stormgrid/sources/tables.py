"""Stored tables: scan by name, pruned and filtered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Catalog table ``name``; both the column list and the SQL predicate reach the file scan."""
    df = spark.table(name)
    if where and where.strip().upper() != "TRUE":
        df = df.where(F.expr(where))
    return df.select(*columns) if columns else df


def existing(spark: SparkSession, names: list[str]) -> list[str]:
    """Names the catalog has, without repeats, in the given order."""
    return [n for n in dict.fromkeys(names) if spark.catalog.tableExists(n)]


def alias_view(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Stable name over the newest result."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def run_row(runs: DataFrame, run_id: int) -> DataFrame:
    """The run with this id; LookupError when there is none."""
    found = runs.where(F.col("run_id") == run_id)
    if found.isEmpty():
        raise LookupError(f"no run with run_id={run_id}")
    return found
