"""Frames behind the maps: colours, marker sizes, bounds, GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators.union import union_centroid  # noqa: F401 - part of this surface


def hail_markers(points: DataFrame, size: str = "maxsize", severity: str = "sevprob", typical: float = 5.0,
                 fallback: float = 3.0) -> DataFrame:
    """Marker ``radius`` (largest = ``typical``; missing or zero = ``fallback``) and ``severity`` in 0..1.

    The scales come from one global aggregate; its single row enters the projection as literals.
    """
    big, lo, hi = points.agg(F.max(size), F.min(severity), F.max(severity)).first()
    factor = typical / big if big else 1.0
    grown = F.when(F.coalesce(F.col(size), F.lit(0)) == 0, fallback).otherwise(F.col(size) * factor)
    spread = (F.col(severity) - F.lit(lo)) / F.lit(float(hi - lo)) if lo is not None and hi > lo else F.lit(0.0)
    return points.withColumns({"radius": grown, "severity": F.coalesce(spread, F.lit(0.0))})


def total_bounds(shapes: DataFrame) -> DataFrame:
    b = shapes.agg(F.min("xmin").alias("minx"), F.min("ymin").alias("miny"), F.max("xmax").alias("maxx"), F.max("ymax").alias("maxy"))
    return b.select("*", ((F.col("miny") + F.col("maxy")) / 2).alias("center_lat"), ((F.col("minx") + F.col("maxx")) / 2).alias("center_lon"))


def joint_centroid(shapes: DataFrame, ring: str = "ring") -> DataFrame:
    """Area-weighted centroid of disjoint polygons; one partial sum per task. ``union_centroid`` counts overlaps once."""
    c, a = geo.centroid(F.col(ring)), geo.area(F.col(ring))
    return (shapes.select(c.alias("c"), a.alias("a"))
            .agg((F.sum(F.col("c.x") * F.col("a")) / F.sum("a")).alias("lon"), (F.sum(F.col("c.y") * F.col("a")) / F.sum("a")).alias("lat")))


def cluster_colors(df: DataFrame, key: str = "cluster_id", flip: int = 0) -> DataFrame:
    return df.withColumn("color", text.hex_color(key, flip))


def feature(geometry: Column, properties: list[str]) -> Column:
    """One GeoJSON feature as text."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")),
                     {"ignoreNullFields": "false"})
