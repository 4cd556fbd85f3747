"""Row-level relational steps: de-duplication, top rows, upserts, batches, alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbering import ranges


def pick_per_key(df: DataFrame, keys: list[Column], order: Column, last: bool = False) -> DataFrame:
    """One whole row per key, the smallest (or largest) ``order``; a null order comes after all others.

    The planner limits the ranking to the first row of every key before the shuffle as well, so a key with a third of all
    rows sends one row per task, and rows are sorted, not copied through an aggregation buffer.
    """
    best = Window.partitionBy(*keys).orderBy(order.desc_nulls_last() if last else order.asc_nulls_last())
    return df.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def latest_per(df: DataFrame, key: str, order: Column) -> DataFrame:
    return pick_per_key(df, [F.col(key)], order, last=True)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows; planned as a per-task top-n with one merge."""
    return df.orderBy(*order).limit(n)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], version: Column, now: Column | None = None,
           kept: tuple[str, ...] = ("created_at",), renewed: str = "updated_at") -> DataFrame:
    """Target with the last update of every key applied: all other columns are replaced, ``kept`` stay.

    Columns that only the updates have are added, but for a plain ``version`` column; those that only the target
    has become null in updated rows.
    """
    newest = pick_per_key(updates, [F.col(k) for k in keys], version, last=True)
    if (name := version._jc.toString()) not in target.columns:
        newest = newest.drop(name)
    stamps = [F.lit(None).cast("timestamp_ntz").alias(c) for c in (*kept, renewed)
              if now is not None and c not in target.columns and c not in updates.columns]
    target = align(target.select("*", *stamps), evolve(target.select("*", *stamps), newest))
    newest = newest.select("*", *[F.lit(None).cast(target.schema[c].dataType).alias(c)
                                  for c in target.columns if c not in newest.columns])
    old = target.select(*[F.col(c).alias(f"o_{c}") for c in target.columns], F.lit(True).alias("_old"))
    on = [F.col(k) == F.col(f"o_{k}") for k in keys]
    both = newest.withColumn("_new", F.lit(True)).join(old, on, "full_outer")
    out = []
    for c in target.columns:
        if c == renewed and now is not None:
            v = F.when(F.col("_new"), now).otherwise(F.col(f"o_{c}"))
        elif c in kept:
            v = F.when(F.col("_old"), F.col(f"o_{c}")).otherwise(now if now is not None else F.col(c))
        else:
            v = F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"o_{c}"))
        out.append(v.alias(c))
    return both.select(*out)


def absent_rows(target: DataFrame, rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Rows whose key (null equals null) the target lacks, first of each key."""
    fresh = pick_per_key(rows, [F.col(k) for k in keys], order)
    there = target.select(*[F.col(k).alias(f"t_{k}") for k in keys]).distinct()
    return fresh.join(there, [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys], "left_anti")


def coalesce_update(target: DataFrame, updates: DataFrame, key: str, fields: list[str], set_once: dict[str, Column],
                    cleared: tuple[str, ...] = ()) -> DataFrame:
    """Update matched rows: a blank or missing new value keeps the old; ``set_once`` only fills nulls.

    ``updates`` has one row per key.
    """
    new = updates.select(F.col(key), *[F.col(f).alias(f"n_{f}") for f in fields], F.lit(True).alias("_hit"))
    both = target.join(new, key, "left")
    out = []
    for c in target.columns:
        v = F.col(c)
        if c in fields:
            v = F.coalesce(F.nullif(F.col(f"n_{c}"), F.lit("")), v)
        elif c in set_once:
            v = F.when(F.col("_hit"), F.coalesce(v, set_once[c])).otherwise(v)
        elif c in cleared:
            v = F.when(F.col("_hit"), F.lit(None)).otherwise(v)
        out.append(v.alias(c))
    return both.select(*out)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types; missing ones null, others dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def evolve(target: DataFrame, df: DataFrame) -> T.StructType:
    """Target schema plus the columns only ``df`` has."""
    have = {c.lower() for c in target.columns}
    return T.StructType([*target.schema.fields, *[f for f in df.schema.fields if f.name.lower() not in have]])


def union_windows(parts: list[DataFrame], key: list[str], order: Column | None = None) -> DataFrame:
    """Union by name of overlapping windows, one row per key."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return pick_per_key(out, [F.col(k) for k in key], F.lit(0) if order is None else order)


def batches(df: DataFrame, order: list[str], size: int, entry: Column) -> DataFrame:
    """Rows in ``order`` cut into batches: ``(batch_id, num_rows, entries)``; a group holds ``size`` rows.

    Rows are dealt by range once and cut where they are sorted; only batches that lie across the border of two ranges are
    put together afterwards.
    """
    rows = df.select(*order, entry.alias("entry"))
    most = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + rows.count() // (8 * size))
    cut = ranges(rows, order, most)
    start, end = (F.element_at(F.lit(cut.starts).cast("array<long>"), F.col("_part") + k) for k in (1, 2))
    numbered = rows.withColumn("_part", cut.part).withColumn(
        "idx", start + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    parts = numbered.groupBy("_part", F.floor(F.col("idx") / size).alias("batch_id")).agg(
        F.count("*").alias("num_rows"), F.sort_array(F.collect_list(F.struct("idx", "entry"))).alias("e"))
    first = F.col("batch_id") * size
    whole = (first >= start) & ((first + size <= end) | (end == cut.starts[-1]))
    joined = parts.where(~whole).groupBy("batch_id").agg(F.sum("num_rows").alias("num_rows"), F.sort_array(
        F.flatten(F.collect_list("e"))).alias("e"))
    return parts.where(whole).select("batch_id", "num_rows", "e").unionByName(joined).select(
        "batch_id", "num_rows", F.transform("e", lambda r: r["entry"]).alias("entries"))
