"""Landed radar products and storm-event files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo
from ..operators.rows import pick_per_key

# Product names by geometry
POINT_PRODUCTS = ("nx3tvs", "nx3meso", "nx3hail", "nx3structure")
POLYGON_PRODUCTS = ("warn",)

# Fixed value: release name of a storm-event details file
RELEASE = r"StormEvents_details-ftp_v1\.0_d(\d{4})_c(\d{8})\.csv\.gz$"


def read_product(spark: SparkSession, root: str, product: str, *, states: list[str] | None = None,
                 start: str | None = None, end: str | None = None, box: str | None = None,
                 fmt: str = "parquet", span_days: int = 45, overlaps: bool = True) -> DataFrame:
    """Product rows from ``root/dataset=../state=../chunk_start=..``.

    Dataset, state and chunk prune directories, from both ends: no chunk is longer than ``span_days``; time and
    box reach the file scan. ``overlaps=False`` says that windows do not overlap, as in a table that only
    ``land_product`` with one span has written: the read then needs no shuffle. One table serves all
    states and windows, and overlapping windows are reduced to one row per id and state.
    """
    if product not in POINT_PRODUCTS + POLYGON_PRODUCTS:
        raise ValueError(f"unknown product {product!r}")
    polygons = product in POLYGON_PRODUCTS
    schema = (schemas.WARNINGS if polygons else schemas.HAIL_POINTS) + ", dataset string, state string, chunk_start date"
    df = spark.read.format(fmt).schema(schema).load(root).where(F.col("dataset") == product)
    if states:
        df = df.where(F.col("state").isin(states))
    if start:
        df = df.where((F.col("valid") >= F.lit(start).cast("timestamp_ntz"))
                      & (F.col("chunk_start") > F.date_sub(F.lit(start).cast("date"), span_days)))
    if end:
        df = df.where((F.col("valid") < F.lit(end).cast("timestamp_ntz")) & (F.col("chunk_start") < F.lit(end).cast("date")))
    if box:
        b = geo.parse_box(box)
        if polygons:
            edges = geo.bounds(F.col("ring"))
            df = df.where(geo.boxes_meet(edges["xmin"], edges["ymin"], edges["xmax"], edges["ymax"], b))
        else:
            df = df.where(geo.in_box("lon", "lat", *b))
    if not overlaps:
        return df
    return pick_per_key(df, [F.col("state"), F.col("id")], F.struct("chunk_start", "valid"), last=True)


def read_storm_details(spark: SparkSession, path) -> DataFrame:
    """Gzip CSV with a header; only the columns asked for later are parsed.

    Times come as the files write them (``28-APR-24 13:45:00``) or in ISO form; other texts are null.
    """
    full = spark.read.option("header", True).option("enforceSchema", False).option("inferSchema", False).csv(path)
    fields = [f.strip().split(" ") for f in schemas.STORM_DETAILS.split(",")]
    def parsed(name: str, kind: str) -> Column:
        plain = F.col(name).try_cast(kind)
        if not kind.startswith("timestamp"):
            return plain
        return F.coalesce(F.try_to_timestamp(F.col(name), F.lit("dd-MMM-yy HH:mm:ss")).cast(kind), plain)

    return full.select(*[parsed(n, t).alias(n) for n, t in fields],
                       F.col("_metadata.file_path").alias("source_file"))


def latest_releases(files: DataFrame, path: str = "path") -> DataFrame:
    """``(year, release, path)`` of the newest release of every year; other names are ignored."""
    named = files.select(F.col(path).alias("path"), F.regexp_extract(path, RELEASE, 1).alias("year"),
                         F.regexp_extract(path, RELEASE, 2).alias("release")).where("year <> ''")
    return named.groupBy("year").agg(F.max("release").alias("release"),
                                     F.max_by("path", F.struct("release", "path")).alias("path"))


def read_latest_details(spark: SparkSession, folder: str) -> DataFrame:
    """Details rows of the newest release of every year found in ``folder``.

    The list of names is read without contents; at most one file per four-digit year is kept, so the
    paths are few enough to name in the read.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "StormEvents_details*").load(folder).select("path")
    return read_storm_details(spark, [r.path for r in latest_releases(names).select("path").collect()])


def date_or_box(df: DataFrame, *, start: str | None = None, end: str | None = None, box: str | None = None,
                day: str = "event_date", x: str = "lon", y: str = "lat") -> DataFrame:
    """Dates with both ends included and / or an envelope; without arguments everything."""
    if start:
        df = df.where(F.col(day) >= F.lit(start).cast(df.schema[day].dataType))
    if end:
        df = df.where(F.col(day) <= F.lit(end).cast(df.schema[day].dataType))
    if box:
        df = df.where(geo.in_box(x, y, *geo.parse_box(box)))
    return df
