"""Global row numbers without a one-partition window."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def ordered_index(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """Add 0-based positions of rows in ``order`` (a total order of the rows).

    Rows are range partitioned and sorted; a row's position is its offset inside its partition plus the
    sizes of the partitions before it. The only unpartitioned window runs over one row per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = durable(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _ROW_BITS)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (tagged.withColumn("_part", part)
            .join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + local)
            .drop("_mid", "_part", "_start"))


_SAMPLE = 40            # rows of the order columns sampled for each range


class Ranges(NamedTuple):
    """A column that tells a row's range, and where each range begins in the whole order; one more for the end."""
    part: Column
    starts: list[int]


def ranges(df: DataFrame, order: list[str], most: int) -> Ranges:
    """Cut the rows of ``df`` in ``order`` (a total order, nulls first) into at most ``most`` ranges of about equal size.

    Split rows come from a sample of the order columns and enter the plan as literals, so the ranges are the same in every
    task and job; their sizes are an aggregate over the order columns alone. The driver holds ``most`` split rows and sizes.
    """
    keys = df.select(F.struct(*order).alias("key"))
    total = keys.count()
    sample = keys.sample(min(1.0, _SAMPLE * most / max(total, 1)), seed=7).sort("key").collect() if most > 1 else []
    splits = [sample[len(sample) * i // most]["key"] for i in range(1, most)] if len(sample) >= most else []
    kind = keys.schema["key"].dataType
    key = F.struct(*order)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        at = F.struct(*[F.lit(splits[mid][f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])
        return F.when(key < at, tree(lo, mid)).otherwise(tree(mid + 1, hi))

    part = tree(0, len(splits))
    sizes = {r["part"]: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}
    starts = [0]
    for i in range(len(splits) + 1):
        starts.append(starts[-1] + sizes.get(i, 0))
    return Ranges(part, starts)


def index_within(df: DataFrame, by: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """Positions counted from 0 again inside every ``by`` group, whatever the group sizes are."""
    if not by:
        return ordered_index(df, order, name)
    flat = ordered_index(df, [*by, *order], "_g")
    base = flat.groupBy(*by).agg(F.min("_g").alias("_base"))
    return flat.join(base, by).withColumn(name, F.col("_g") - F.col("_base")).drop("_g", "_base")
