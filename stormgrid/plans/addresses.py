"""Addresses in, near and around storms; the target export; address clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import not_multi_unit, not_po_box
from ..functions.timing import storm_time
from ..operators import cellindex, gridjoin
from ..operators.dbscan import dbscan
from ..operators.hull import convex_hulls
from ..operators.rows import pick_per_key, top

_SHAPE = ["ring", "xmin", "ymin", "xmax", "ymax"]


def _listed(key: str | tuple[str, ...]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _shape(storms: DataFrame) -> list[str]:
    return _SHAPE + [c for c in ("holes",) if c in storms.columns]


def _plain(storms: DataFrame, convex: bool) -> bool:
    return convex and "holes" not in storms.columns


def in_storms(addresses: DataFrame, storms: DataFrame, key: str | tuple[str, ...] = "cluster_id", event=None, convex: bool = True,
              id_col: str = "id") -> DataFrame:
    """One row per address strictly inside a storm polygon; ``event`` limits to one storm: the value of its key, or one per key.

    A storm may be several rows (parts); a column ``holes`` is left out of its part. Rings that are not convex need ``convex=False``.
    """
    keys = _listed(key)
    if event is not None:
        for k, v in zip(keys, [event] if isinstance(key, str) else event):
            storms = storms.where(F.col(k) == v)
    storms = storms.select(*[F.col(k).alias(f"_storm{i}") for i, k in enumerate(keys)], *_shape(storms))
    names = [f"_storm{i}" for i in range(len(keys))]
    found = cellindex.inside(addresses, storms, names, _plain(storms, convex), id_col=id_col)
    return cellindex.with_rows(addresses, found, id_col).withColumnsRenamed(dict(zip(names, keys)))


def in_any_storm(addresses: DataFrame, storms: DataFrame, key: str = "id", convex: bool = True) -> DataFrame:
    """Addresses within the union of the polygons, each once; ``key`` is the addresses' id."""
    found = cellindex.inside(addresses, storms.select(*_shape(storms)), [], _plain(storms, convex), id_col=key)
    once = found.withColumnsRenamed({"id": "_id", "x": "_x", "y": "_y"})
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.col("lon") == F.col("_x")) & (F.col("lat") == F.col("_y"))
    return addresses.join(once, same, "left_semi")


def near_storms(addresses: DataFrame, storms: DataFrame, metres: float, keep: tuple[str, ...] = ("cluster_id",),
                id_col: str = "id") -> DataFrame:
    """Address-storm pairs within ``metres``, with the distance (0 inside); parts of any shape, the inside of ``holes`` is outside."""
    found = cellindex.near(addresses, storms.select(*keep, *_shape(storms)), list(keep), metres, id_col=id_col)
    return cellindex.with_rows(addresses, found, id_col)


def storms_in_area(storms: DataFrame, center: tuple[float, float], radius_m: float, convex: bool = True) -> DataFrame:
    """Polygons that meet the search area, a buffer in Web-Mercator metres."""
    area = geo.mercator_circle(*center, radius_m)
    near = storms.where(geo.boxes_meet("xmin", "ymin", "xmax", "ymax", _box(area)))
    return near.where(geo.convex_meet(F.col("ring"), area) if _plain(storms, convex) else
                      geo.part_meets_convex(F.col("ring"), _holes(storms), area))


def _holes(storms: DataFrame) -> Column:
    return F.col("holes") if "holes" in storms.columns else F.slice(F.array("ring"), 1, 0)


def storms_in_box(storms: DataFrame, box: str, convex: bool = True) -> DataFrame:
    """Polygons that meet the envelope ``"minlon,minlat,maxlon,maxlat"``: the comparison of envelopes
    prunes in the scan, the exact test sees what is left."""
    x0, y0, x1, y1 = geo.parse_box(box)
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    near = storms.where(geo.boxes_meet("xmin", "ymin", "xmax", "ymax", (x0, y0, x1, y1)))
    return near.where(geo.convex_meet(F.col("ring"), corners) if _plain(storms, convex) else
                      geo.part_meets_box(F.col("ring"), _holes(storms), (x0, y0, x1, y1)))


def points_in_area(points: DataFrame, center: tuple[float, float], radius_m: float) -> DataFrame:
    area = geo.mercator_circle(*center, radius_m)
    return (points.where(geo.in_box("lon", "lat", *_box(area)))
            .where(geo.in_convex(geo.literal_ring(area), F.col("lon"), F.col("lat"), strict=False)))


def _box(ring):
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return min(xs), min(ys), max(xs), max(ys)


def deliverable(addresses: DataFrame, multi_units: bool = False) -> DataFrame:
    """No missing address, no PO box, no multi-unit address unless asked for."""
    out = addresses.where(F.col("address").isNotNull() & not_po_box("address"))
    return out if multi_units else out.where(not_multi_unit("address"))


def distinct_addresses(addresses: DataFrame, order: str = "id") -> DataFrame:
    """One row per address text (any case) and zip: the lowest id."""
    return pick_per_key(addresses, [F.lower(F.coalesce("address", F.lit(""))), F.coalesce("zip", F.lit(""))], F.col(order))


def skiptrace_targets(addresses: DataFrame, storms: DataFrame, state: str | None, center: tuple[float, float],
                      radius_km: float = 40.0, dist_m: float = 200.0, n: int = 1000, multi_units: bool = False,
                      keys: tuple[str, ...] = ("cluster_id",)) -> DataFrame:
    """Deliverable addresses near storms of a search area, newest storm first, then nearest.

    ``keys`` identify a storm; those other than ``cluster_id`` (storms numbered per state) are returned as ``hail_..``.

    De-duplication comes after the address filters and before the join, so an address near several
    storms gives several rows.
    """
    radius_m = round(radius_km * 1000.0)
    if state:
        addresses = addresses.where(F.col("state") == state.strip().upper())
    addr = distinct_addresses(points_in_area(deliverable(addresses, multi_units), center, radius_m))
    more = [hail_key(k) for k in keys if k != "cluster_id"]
    storms = storms.select("*", *[F.col(k).alias(hail_key(k)) for k in keys if k != "cluster_id"])
    near = near_storms(addr, storms_in_area(storms, center, radius_m), dist_m,
                       ("cluster_id", *more, "start_time", "end_time"))
    out = near.select("id", "address", "street", "city", "state", "zip", "lon", "lat", "cluster_id", *more,
                      storm_time("start_time", "end_time").alias("storm_time"),
                      F.round(F.col("distance").cast("decimal(18,6)"), 1).alias("distance_m"))
    return top(out, n, F.desc_nulls_last("storm_time"), F.asc("distance_m"), F.asc("id"), F.asc("cluster_id"), *map(F.asc, more))


def hail_key(key: str) -> str:
    """Name of a storm's key beside an address's own columns."""
    return f"hail_{key}"


def around_centroids(addresses: DataFrame, storms: DataFrame, radius: float,
                     keys: tuple[str, ...] = ("cluster_id",)) -> DataFrame:
    """Addresses inside (or on) a planar buffer of each storm's centroid; an address may meet several.

    ``keys`` identify a storm: add ``state`` where storms are numbered per state.
    """
    c = geo.centroid(F.col("ring"))
    names = [hail_key(k) for k in keys]
    spots = (storms.select(*[F.col(k).alias(hail_key(k)) for k in keys], c.alias("c"))
             .select(*names, F.col("c.x").alias("cx"), F.col("c.y").alias("cy"))
             .withColumns({"xmin": F.col("cx") - radius, "xmax": F.col("cx") + radius,
                           "ymin": F.col("cy") - radius, "ymax": F.col("cy") + radius}))
    inside = geo.in_point_buffer("lon", "lat", F.col("cx"), F.col("cy"), F.lit(radius))
    return gridjoin.points_in_polygons(addresses, spots, inside).drop("xmin", "xmax", "ymin", "ymax", "cx", "cy")


def label_addresses(addresses: DataFrame, storms: DataFrame, radius: float = 0.01, eps: float = 0.0006,
                    min_samples: int = 8, keys: tuple[str, ...] = ("cluster_id",)) -> DataFrame:
    """Addresses around each storm, clustered per storm: adds ``hail_<key>..`` and ``addr_cluster_id``."""
    near = around_centroids(addresses.select("id", "lon", "lat"), storms, radius, keys)
    return dbscan(near, eps, min_samples, by=[hail_key(k) for k in keys], label="addr_cluster_id")


def address_clusters(labelled: DataFrame, keys: tuple[str, ...] = ("cluster_id",)) -> DataFrame:
    """Hull and size of every address cluster; the hull may be a line or a point."""
    keys = [*map(hail_key, keys), "addr_cluster_id"]
    kept = labelled.where("addr_cluster_id >= 0")
    sizes = kept.groupBy(*keys).agg(F.count("*").alias("num_addresses"), F.min("lon").alias("xmin"),
                                    F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax"))
    return sizes.join(convex_hulls(kept, keys), keys)


def untraced(addresses: DataFrame, traces: DataFrame, n: int) -> DataFrame:
    """First ``n`` addresses without a trace."""
    todo = addresses.join(traces.select(F.col("address_id").alias("id")).distinct(), "id", "left_anti")
    return top(todo.select("id", "address"), n, F.asc("id"))
