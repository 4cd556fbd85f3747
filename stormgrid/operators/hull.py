"""Convex hulls per key; no task ever holds all points of a key.

Each key's extent in sixteen fixed directions is a plain aggregate (primitive buffers, merged before the shuffle). The hull touches every
one of the sixteen lines, so whatever lies inside all chords that cut off one corner of that polygon is inside the hull;
such points, nine of ten in an even spread, are dropped by comparisons in the JVM. The rest is deduplicated and reduced per (key, salt), then
per key, with as many salts as the root of the key's own count asks for. All this is for keys of many points only: those of at most 256
are one short list each, and reduced once.

Turns are signed exactly, so the hull does not depend on how the points were dealt. Only the finished hull loses
vertices whose turn the rounding of the coordinates alone could explain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import staged

_DIRECTIONS = 16
_PART = 16                              # a key of n points has sqrt(n) / _PART salts
_FEW = _PART ** 2                       # a key of so many points would have one salt: no supports, no salt
_MARGIN = 64 * 2.0 ** -52               # what rounding may add to a distance, in units of the largest coordinate
_FILTER = (3 + 16 * 2.0 ** -53) * 2.0 ** -53     # relative error of a determinant of differences


def turn(a: tuple, b: tuple, c: tuple) -> int:
    """Sign of the turn a -> b -> c, exact: 1 left, -1 right, 0 straight."""
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    det = left - right
    if abs(det) <= _FILTER * (abs(left) + abs(right)):
        (ax, ay), (bx, by), (cx, cy) = (map(Fraction, p) for p in (a, b, c))
        det = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (det > 0) - (det < 0)


def _chain(points, keeps) -> list:
    out: list = []
    for p in points:
        while len(out) > 1 and not keeps(out[-2], out[-1], p):
            out.pop()
        out.append(p)
    return out


def _around(pts: list, keeps) -> list:
    if len(pts) < 3:
        return pts
    return _chain(pts, keeps)[:-1] + _chain(reversed(pts), keeps)[:-1]


def exact_hull(points) -> list[tuple]:
    """Vertices counter-clockwise from the lowest (x, y), none on an edge; 1 or 2 if degenerate."""
    return _around(sorted(set(points)), lambda a, b, c: turn(a, b, c) > 0)


def settled(vertices: list[tuple]) -> list[tuple]:
    """Hull without the vertices whose turn is within the rounding of the coordinates."""
    if len(vertices) < 3:
        return vertices
    ulp = max(max(abs(x), abs(y)) for x, y in vertices) * 2.0 ** -52

    def plain(a, b, c):
        ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], c[0] - a[0], c[1] - a[1]
        return ux * vy - uy * vx > ulp * (abs(ux) + abs(uy) + abs(vx) + abs(vy))

    return _around(sorted(vertices), plain)


def hull_points(xy: np.ndarray) -> np.ndarray:
    """Hull of an array of points, as ``convex_hulls`` gives it."""
    return np.array(settled(exact_hull(map(tuple, xy.tolist()))))


def _supports(points: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the count and, for each of the chords that cut off a corner, ``a<k> * x + b<k> * y > c<k>`` for what is inside."""
    half = _DIRECTIONS // 2
    turns = [(math.cos(2 * math.pi * k / _DIRECTIONS), math.sin(2 * math.pi * k / _DIRECTIONS)) for k in range(_DIRECTIONS)]
    reach = [F.col("px") * cx + F.col("py") * cy for cx, cy in turns[:half]]
    got = points.groupBy(*keys).agg(
        F.count("*").alias("n"), F.max(F.greatest(F.abs("px"), F.abs("py"))).alias("size"),
        *[F.max(d).alias(f"h{k}") for k, d in enumerate(reach)], *[(-F.min(d)).alias(f"h{k + half}") for k, d in enumerate(reach)])
    step = math.sin(2 * math.pi / _DIRECTIONS)
    corner = {}
    for k in range(_DIRECTIONS):
        (c0, s0), (c1, s1) = turns[k], turns[(k + 1) % _DIRECTIONS]
        h0, h1 = F.col(f"h{k}"), F.col(f"h{(k + 1) % _DIRECTIONS}")
        corner[k] = ((h0 * s1 - h1 * s0) / step, (h1 * c0 - h0 * c1) / step)
    got = got.select(*keys, "n", "size", *[c.alias(f"{n}{k}") for k, v in corner.items() for n, c in zip("xy", v)])
    lines = []
    for k in range(_DIRECTIONS):
        p, q = (k - 1) % _DIRECTIONS, (k + 1) % _DIRECTIONS
        a, b = F.col(f"y{p}") - F.col(f"y{q}"), F.col(f"x{q}") - F.col(f"x{p}")
        lines += [a.alias(f"a{k}"), b.alias(f"b{k}"), (a * F.col(f"x{p}") + b * F.col(f"y{p}") + _MARGIN * F.col("size")
                                                       * (F.abs(a) + F.abs(b))).alias(f"c{k}")]
    return staged(got.select(*keys, "n", *lines), "hull-supports")


def _outer(points: DataFrame, supports: DataFrame, keys: list[str]) -> DataFrame:
    inside = F.lit(True)
    for k in range(_DIRECTIONS):
        inside = inside & (F.col("px") * F.col(f"a{k}") + F.col("py") * F.col(f"b{k}") > F.col(f"c{k}"))
    salts = F.ceil(F.sqrt("n") / _PART)
    return points.join(supports, keys).where(~inside).select(
        *keys, "px", "py", F.pmod(F.xxhash64("px", "py"), salts).alias("salt"))


def convex_hulls(df: DataFrame, keys: list[str], x: str = "lon", y: str = "lat") -> DataFrame:
    """``(keys.., ring, hull_kind)``: hull_kind is point, line or polygon; rows with a null part drop.

    ``ring`` is closed, counter-clockwise from its lowest (x, y); of a point or line it repeats the one or two vertices.
    """
    points = df.select(*keys, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).dropna()
    many = staged(points.groupBy(*keys).count().where(F.col("count") > _FEW).select(*keys), "hull-many")
    small = points.join(many, keys, "left_anti").groupBy(*keys).agg(F.collect_set(F.struct("px", "py")).alias("pts"))
    hull = small.mapInArrow(_reducer(lambda p: settled(exact_hull(p))), small.schema)
    if not many.isEmpty():
        hull = hull.unionByName(_large_hulls(points.join(many, keys, "left_semi"), keys))
    return hull.select(*keys, closed(F.col("pts")).alias("ring"), kind(F.col("pts")).alias("hull_kind"))


def _large_hulls(points: DataFrame, keys: list[str]) -> DataFrame:
    outer = _outer(points, _supports(points, keys), keys)
    parts = outer.groupBy(*keys, "salt").agg(F.collect_set(F.struct("px", "py")).alias("pts"))
    merged = parts.mapInArrow(_reducer(exact_hull), parts.schema).groupBy(*keys).agg(F.flatten(F.collect_list("pts")).alias("pts"))
    return merged.mapInArrow(_reducer(lambda p: settled(exact_hull(p))), merged.schema)


def closed(pts: Column) -> Column:
    return F.transform(F.concat(pts, F.slice(pts, 1, 1)), lambda p: geo.vertex(p["px"], p["py"]))


def kind(pts: Column) -> Column:
    return F.when(F.size(pts) == 1, "point").when(F.size(pts) == 2, "line").otherwise("polygon")


def solid(ring: str = "ring", kind: str = "hull_kind"):
    """A polygon of non-zero area: points and lines get a buffer of 1e-6 degrees."""
    r = F.col(ring)
    return (F.when(F.col(kind) == "point", geo.point_buffer(r[0]["x"], r[0]["y"], 1e-6))
            .when(F.col(kind) == "line", geo.segment_buffer(r[0], r[1], 1e-6))
            .otherwise(r))


def _reducer(hull):
    """Every row's list of points to its hull."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            lists = b.column("pts")
            flat = lists.flatten()
            px, py = flat.field("px").to_pylist(), flat.field("py").to_pylist()
            ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
            out = [hull(zip(px[s:e], py[s:e])) for s, e in zip([0, *ends], ends)]
            offsets = np.cumsum([0, *map(len, out)]).astype(np.int32)
            inner = lists.type.value_type
            struct = pa.StructArray.from_arrays([pa.array([p[i] for o in out for p in o], pa.float64()) for i in (0, 1)],
                                                fields=[inner.field(0), inner.field(1)])
            arr = pa.ListArray.from_arrays(pa.array(offsets), struct)
            yield pa.RecordBatch.from_arrays([arr if f.name == "pts" else b.column(f.name) for f in b.schema],
                                             names=b.schema.names)
    return run
