"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys above HOT_ROWS rows are candidates; only the MAX_HOT largest are treated apart, so whatever is
# broadcast has at most MAX_HOT keys and a key outside that list holds under 1/MAX_HOT of all rows.
HOT_ROWS = 200_000
MAX_HOT = 1_000
# Rows of rules that may be broadcast in all.
MAX_RULES = 500_000
SPREAD = 4_096


def hottest(sizes: DataFrame, keys: list[str], size: str, hot_rows: int = HOT_ROWS, most: int = MAX_HOT) -> DataFrame:
    """At most ``most`` rows of ``sizes`` (unique per key): the keys above ``hot_rows``."""
    return sizes.where(F.col(size) > hot_rows).orderBy(F.col(size).desc(), *keys).limit(most)


def lookup(big: DataFrame, small: DataFrame, keys: list[str], size: str, values: list[str],
           hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Left join ``values`` of ``small`` (unique per key, ``size`` = matching rows in ``big``) onto ``big``.

    Rows of hot keys get their values from a bounded broadcast and are spread over SPREAD salts in the
    shuffle that serves the other keys: one pass over ``big``, no hot partition. ``hot_rows=None`` says
    the caller has checked that no key is hot.
    """
    if hot_rows is None:
        return big.join(small.select(*keys, *values), keys, "left").select(*big.columns, *values)
    hot = hottest(small, keys, size, hot_rows).select(
        *keys, F.struct(*values).alias("_hot"))
    cold = small.select(*keys, F.lit(0).alias("_salt"), F.struct(*values).alias("_cold"))
    # the salt follows from the row, so that a stage run again after a loss deals the same rows
    salt = F.pmod(F.xxhash64(*big.columns), F.lit(SPREAD)).cast("int")
    flagged = big.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), 1 + salt).otherwise(0))
    out = flagged.join(cold, [*keys, "_salt"], "left")
    picked = F.coalesce("_hot", "_cold")
    return out.select(*[F.col(c) for c in big.columns], *[picked[v].alias(v) for v in values])


def expand(big: DataFrame, rules: DataFrame, keys: list[str], size: str, per_key: int,
           hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Inner join ``big`` with ``rules``, which hold at most ``per_key`` rows per key.

    ``size`` in ``rules`` is the number of matching rows in ``big``. Rules of hot keys are broadcast
    (as many keys as fit MAX_RULES rows at ``per_key`` each), the others meet ``big`` in a shuffle that hot rows never enter.
    ``hot_rows=None`` says the caller has checked that no key is hot.
    """
    if hot_rows is None:
        return big.join(rules, keys)
    sizes = rules.groupBy(*keys).agg(F.max(size).alias(size))
    hot = hottest(sizes, keys, size, hot_rows, min(MAX_HOT, MAX_RULES // per_key)).select(*keys)
    hot_rules = rules.join(F.broadcast(hot), keys, "left_semi")
    cold_rules = rules.join(F.broadcast(hot), keys, "left_anti")
    return big.join(F.broadcast(hot_rules), keys).unionByName(
        big.join(F.broadcast(hot), keys, "left_anti").join(cold_rules, keys))
