"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def known(ts) -> Column:
    """The epoch stands for a missing time."""
    return F.nullif(_c(ts).cast("timestamp_ntz"), F.expr(EPOCH))


def storm_time(start, end) -> Column:
    return F.coalesce(known(end), known(start))


def utc_or_null(text) -> Column:
    return _c(text).try_cast("timestamp_ntz")


def label(ts) -> Column:
    return F.date_format(_c(ts), "MM-dd HH:mm")


def recent(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Rows of the last ``days`` before ``as_of`` (an argument, so results repeat)."""
    return df.where(F.col(ts) >= F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {int(days)} DAYS"))


def date_chunks(spark: SparkSession, start: str, end: str, span: int) -> DataFrame:
    """``[start, end)`` cut into chunks of ``span`` days, the last one short."""
    return spark.sql(f"""
        select cast(datediff(d, DATE '{start}') / {int(span)} as int) as chunk, d as chunk_start,
               least(date_add(d, {int(span)}), DATE '{end}') as chunk_end
        from (select explode(case when DATE '{start}' < DATE '{end}'
              then sequence(DATE '{start}', date_sub(DATE '{end}', 1), INTERVAL {int(span)} DAYS)
              else array() end) as d)""")


def in_chunks(df: DataFrame, ts: str, start: str, end: str, span: int) -> DataFrame:
    """Add the chunk of each row; rows outside ``[start, end)`` drop. No join with the chunk list."""
    d = F.col(ts)
    inside = df.where((d >= F.expr(f"TIMESTAMP_NTZ '{start} 00:00:00'")) & (d < F.expr(f"TIMESTAMP_NTZ '{end} 00:00:00'")))
    return (inside.withColumn("chunk", F.floor(F.datediff(d, F.lit(start)) / span).cast("int"))
            .withColumn("chunk_start", F.date_add(F.lit(start).cast("date"), F.col("chunk") * span)))
