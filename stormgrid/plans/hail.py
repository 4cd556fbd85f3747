"""Hail points -> clusters -> polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.dbscan import dbscan
from ..operators.hull import convex_hulls, solid

# Ordered (start, end) column candidates of hail sources
TIME_CANDIDATES = [("begin_time", "end_time"), ("start_time", "end_time"), ("btm", "etm"), ("valid", None),
                   ("datetime", None), ("obs_time", None), ("time", None)]


def time_columns(df: DataFrame) -> tuple[str | None, str | None]:
    """First candidate whose start column exists, matched without regard to case."""
    have = {c.lower(): c for c in df.columns}
    for start, end in TIME_CANDIDATES:
        if start in have:
            return have[start], have.get(end)
    return None, None


def as_time(df: DataFrame, name: str):
    """UTC time without zone; text that does not parse becomes null."""
    kind = df.schema[name].dataType.simpleString()
    c = F.col(name)
    return c if kind == "timestamp_ntz" else \
        c.try_cast("timestamp_ntz") if kind == "string" else c.cast("timestamp_ntz")


def label_hail(points: DataFrame, eps: float = 0.03, min_samples: int = 6, by: list[str] | None = None, **cols) -> DataFrame:
    """Add ``cluster_id``; with ``by`` (states, runs) every group is clustered on its own in the same jobs."""
    return dbscan(points, eps, min_samples, by=by, label="cluster_id", **cols)


def cluster_stats(labelled: DataFrame, by: list[str] | None = None, x: str = "lon", y: str = "lat") -> DataFrame:
    """One row per cluster: size, first start, last end, envelope. Noise is left out."""
    start, end = time_columns(labelled)
    null_time = F.lit(None).cast("timestamp_ntz")
    t0 = F.min(as_time(labelled, start)) if start else null_time
    t1 = F.max(as_time(labelled, end or start)) if start else null_time
    return (labelled.where("cluster_id >= 0").groupBy(*(by or []), "cluster_id").agg(
        F.count("*").alias("num_points"), t0.alias("start_time"), t1.alias("end_time"),
        F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax")))


def hail_clusters(points: DataFrame, eps: float = 0.03, min_samples: int = 6, by: list[str] | None = None, **cols) -> DataFrame:
    return cluster_stats(label_hail(points, eps, min_samples, by, **cols), by)


def hail_boundaries(points: DataFrame, eps: float = 0.03, min_samples: int = 6, by: list[str] | None = None) -> DataFrame:
    """Cluster table with a polygon per cluster (points and lines are widened to a sliver)."""
    labelled, keys = label_hail(points, eps, min_samples, by), [*(by or []), "cluster_id"]
    hulls = convex_hulls(labelled.where("cluster_id >= 0"), keys)
    stats = cluster_stats(labelled, by).drop("xmin", "ymin", "xmax", "ymax")
    return (stats.join(hulls, keys).withColumn("ring", solid())
            .withColumns(geo.bounds(F.col("ring"))))


def storm_event_boundaries(details: DataFrame, order: list[str]) -> DataFrame:
    """Hull per (EPISODE_ID, EVENT_ID); other columns come from the first row in ``order``."""
    keys = ["EPISODE_ID", "EVENT_ID"]
    usable = details.dropna(subset=["BEGIN_LAT", "BEGIN_LON"])
    first = F.min_by(F.struct("BEGIN_LON", "BEGIN_LAT"), F.struct(*order))
    attrs = usable.dropna(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("num_points"), F.min("BEGIN_DATE_TIME").alias("begin_time"), first.alias("f"))
    hulls = convex_hulls(usable, keys, "BEGIN_LON", "BEGIN_LAT")
    return (attrs.join(hulls, keys)
            .select("EPISODE_ID", F.col("EVENT_ID").alias("id"), "num_points", "begin_time",
                    F.col("f.BEGIN_LON").alias("first_lon"), F.col("f.BEGIN_LAT").alias("first_lat"),
                    "hull_kind", solid().alias("ring"), geo.area(F.col("ring")).alias("area"))
            .withColumns(geo.bounds(F.col("ring"))))
