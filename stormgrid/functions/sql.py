"""The spatial and text predicates as SQL functions, for callers who write SQL."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udf, udtf

from ..operators import hull

_RING = "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
_SIDE = ("(ring[i].x - ring[i - 1].x) * (py - ring[i - 1].y) - (ring[i].y - ring[i - 1].y) * (px - ring[i - 1].x)")

FUNCTIONS = {
    "sg_contains(ring %s, px DOUBLE, py DOUBLE) RETURNS BOOLEAN" % _RING:
        f"forall(sequence(1, size(ring) - 1), i -> {_SIDE} > 0)",
    "sg_intersects(ring %s, px DOUBLE, py DOUBLE) RETURNS BOOLEAN" % _RING:
        f"forall(sequence(1, size(ring) - 1), i -> {_SIDE} >= 0)",
    "sg_area(ring %s) RETURNS DOUBLE" % _RING:
        "abs(aggregate(sequence(1, size(ring) - 1), 0D, (s, i) -> s + (ring[i - 1].x - ring[0].x) * (ring[i].y - ring[0].y)"
        " - (ring[i].x - ring[0].x) * (ring[i - 1].y - ring[0].y))) / 2",
    "sg_in_envelope(px DOUBLE, py DOUBLE, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE) RETURNS BOOLEAN":
        "px >= x0 AND px <= x1 AND py >= y0 AND py <= y1",
    "sg_in_buffer(px DOUBLE, py DOUBLE, cx DOUBLE, cy DOUBLE, r DOUBLE) RETURNS BOOLEAN":
        "sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)) * cos(pmod(atan2(py - cy, px - cx), pi() / 32) - pi() / 64) <= r * cos(pi() / 64)",
    "sg_mercator_x(lon DOUBLE) RETURNS DOUBLE": "radians(lon) * 6378137D",
    "sg_mercator_y(lat DOUBLE) RETURNS DOUBLE": "ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137D",
    "sg_lon(mx DOUBLE) RETURNS DOUBLE": "degrees(mx / 6378137D)",
    "sg_lat(my DOUBLE) RETURNS DOUBLE": "degrees(2 * atan(exp(my / 6378137D)) - pi() / 2)",
    # squared sines of mean latitude, half latitude and half longitude difference -> arc and its parts -> metres
    "sg_arc_metres(f DOUBLE, g DOUBLE, s DOUBLE, c DOUBLE, w DOUBLE) RETURNS DOUBLE":
        "2 * w * 6378137D * (1 + ((3 * sqrt(s * c) / w - 1) / (2 * c) * f * (1 - g) - (3 * sqrt(s * c) / w + 1) / (2 * s) * (1 - f) * g)"
        " / 298.257223563D)",
    "sg_arc(f DOUBLE, g DOUBLE, l DOUBLE) RETURNS DOUBLE":
        "CASE WHEN g * (1 - l) + (1 - f) * l = 0 THEN 0D ELSE sg_arc_metres(f, g, g * (1 - l) + (1 - f) * l, (1 - g) * (1 - l) + f * l,"
        " atan(sqrt((g * (1 - l) + (1 - f) * l) / ((1 - g) * (1 - l) + f * l)))) END",
    "sg_metres(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE":
        "sg_arc(pow(sin(radians(lat1 + lat2) / 2), 2), pow(sin(radians(lat1 - lat2) / 2), 2), pow(sin(radians(lon1 - lon2) / 2), 2))",
    "sg_circle(lon DOUBLE, lat DOUBLE, metres DOUBLE) RETURNS %s" % _RING:
        "transform(sequence(0, 64), k -> named_struct('x', lon + degrees(metres * cos(k * pi() / 32) * sqrt(1 - 0.0066943799901413165D"
        " * pow(sin(radians(lat)), 2)) / (6378137D * cos(radians(lat)))), 'y', lat + degrees(metres * sin(k * pi() / 32)"
        " * pow(1 - 0.0066943799901413165D * pow(sin(radians(lat)), 2), 1.5D) / (6378137D * (1 - 0.0066943799901413165D)))))",
    "sg_title(s STRING) RETURNS STRING":
        r"array_join(transform(regexp_extract_all(lower(s), '(\\p{L}+|[^\\p{L}]+)', 1), t -> initcap(t)), '')",
    "sg_color(n BIGINT) RETURNS STRING": "concat('#', lpad(lower(hex((n * 2654435761L) & 16777215L)), 6, '0'))",
}


def _hull(x: pa.Array, y: pa.Array) -> list[dict]:
    given = ((a, b) for a, b in zip(x.to_pylist(), y.to_pylist()) if a is not None and b is not None and a == a and b == b)
    return [{"x": a, "y": b} for a, b in hull.settled(hull.exact_hull(given))]


class Cells:
    """Rows ``(gx, gy)``: cells of a side in degrees that an envelope covers; none if a bound is null."""

    def eval(self, x0: float, y0: float, x1: float, y1: float, side: float):
        if None in (x0, y0, x1, y1, side):
            return
        for gx in range(math.floor(x0 / side), math.floor(x1 / side) + 1):
            for gy in range(math.floor(y0 / side), math.floor(y1 / side) + 1):
                yield gx, gy


def register(spark: SparkSession) -> list[str]:
    """Create the functions in this session; returns their names.

    Besides the scalar forms: ``sg_hull(x, y)``, an aggregate giving the hull's vertices counter-clockwise (a group comes to one task, so
    large groups, and only those, are fed hulls of parts: ``sg_hull`` over the exploded hulls of ``GROUP BY k, pmod(hash(x, y), n)``), and the table
    function ``sg_cells(xmin, ymin, xmax, ymax, side)`` for ``LATERAL``, with which a spatial join is one on cells.
    """
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udf.register("sg_hull", arrow_udf(_hull, _RING.lower().replace(": ", ":")))
    spark.udtf.register("sg_cells", udtf(Cells, returnType="gx bigint, gy bigint", useArrow=True))
    return [*[h.split("(")[0] for h in FUNCTIONS], "sg_hull", "sg_cells"]
