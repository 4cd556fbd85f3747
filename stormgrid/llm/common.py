"""What the corpus operators share: row ranges of a batch, row keys, table paths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_ranges(texts: pa.Array, limit: int = 1 << 20):
    """``(start, stop)`` ranges of rows whose texts add up to about ``limit`` bytes, one row at least.

    An Arrow batch may hold ten thousand long texts; numpy work that needs several bytes per input byte
    goes range by range, so a worker's memory follows ``limit`` and the longest single text.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def row_key(*cols: str) -> Column:
    """64-bit key of a row's id and text: rows equal in both are one document, a repeated id is not."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def row_keys(*cols: str) -> tuple[Column, Column]:
    """Two independent hashes of a row's id and text, ``_k1`` and ``_k2``: 128 bits, so that no two documents meet by chance."""
    whole = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.xxhash64(*whole).alias("_k1"), F.xxhash64(F.lit("again"), *whole).alias("_k2")
