"""Planar and geodetic column functions.

A point is two columns (lon, lat in degrees). A polygon is one closed ring,
``array<struct<x:double,y:double>>``, counter-clockwise where it is convex. Everything here is built
from SQL expressions, so no row leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# WGS84 ellipsoid, and the sphere radius of Web Mercator (EPSG:3857)
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
MERCATOR_R = 6378137.0

RING = "array<struct<x:double,y:double>>"


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(float(v))


def vertex(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def literal_ring(points: list[tuple[float, float]]) -> Column:
    return F.array(*[vertex(F.lit(float(x)), F.lit(float(y))) for x, y in points])


def _edges(ring: Column) -> Column:
    """1-based start positions of the ring's edges."""
    return F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))


def _at(ring: Column, i) -> Column:
    return F.get(ring, i - 1)


def _side(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Positive where (x, y) lies left of a -> b."""
    return (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])


# ---- envelopes ---------------------------------------------------------------------------------

def in_box(x, y, xmin, ymin, xmax, ymax) -> Column:
    """Point in a closed envelope; plain comparisons, so it reaches the file scan."""
    x, y = _c(x), _c(y)
    return (x >= xmin) & (x <= xmax) & (y >= ymin) & (y <= ymax)


def boxes_meet(xmin, ymin, xmax, ymax, box: tuple[float, float, float, float]) -> Column:
    return (_c(xmin) <= box[2]) & (_c(xmax) >= box[0]) & (_c(ymin) <= box[3]) & (_c(ymax) >= box[1])


def bounds(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def parse_box(text: str) -> tuple[float, float, float, float]:
    """``"minlon,minlat,maxlon,maxlat"``"""
    a, b, c, d = (float(v) for v in text.split(","))
    return a, b, c, d


def parse_center(text: str) -> tuple[float, float]:
    """``"lon,lat"``; raises ValueError on anything else."""
    lon, lat = (float(v.strip()) for v in text.split(","))
    return lon, lat


# ---- measures ----------------------------------------------------------------------------------

def area(ring: Column) -> Column:
    """Unsigned shoelace area, taken relative to the first vertex."""
    return let(ring, _area)


def _area(ring: Column) -> Column:
    o = _at(ring, F.lit(1))
    return F.abs(F.aggregate(_edges(ring), F.lit(0.0), lambda s, i: s + _side(
        o, _at(ring, i), F.get(ring, i)["x"], F.get(ring, i)["y"]))) / 2


def centroid(ring: Column) -> Column:
    """Area-weighted centroid; the vertex mean when the area is 0."""
    return let(ring, _centroid)


def _centroid(ring: Column) -> Column:
    o = _at(ring, F.lit(1))

    def step(acc, i):
        a, b = _at(ring, i), F.get(ring, i)
        w = _side(o, a, b["x"], b["y"])
        return F.struct((acc["w"] + w).alias("w"),
                        (acc["x"] + w * (a["x"] + b["x"] - 2 * o["x"])).alias("x"),
                        (acc["y"] + w * (a["y"] + b["y"] - 2 * o["y"])).alias("y"))

    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    n = F.greatest(F.size(ring) - 1, F.lit(1))
    open_ring = F.slice(ring, F.lit(1), n)
    mean = lambda f: F.aggregate(open_ring, F.lit(0.0), lambda t, p: t + p[f]) / n
    return let(F.aggregate(_edges(ring), zero, step), lambda s: F.when(
        s["w"] != 0, vertex(o["x"] + s["x"] / (3 * s["w"]), o["y"] + s["y"] / (3 * s["w"])))
        .otherwise(vertex(mean("x"), mean("y"))))


def rings_centroid(polygons: Column) -> Column:
    """Centroid of a (multi)polygon given as ``array<polygon<ring<[x, y]>>>``: holes count against it."""
    rings = F.flatten(F.transform(polygons, lambda poly: F.transform(poly, lambda ring, i: let(
        F.transform(ring, lambda p: vertex(p[0], p[1])),
        lambda r: F.struct((F.when(i == 0, 1.0).otherwise(-1.0) * area(r)).alias("w"), centroid(r).alias("c"))))))
    return let(rings, lambda parts: _weighted(parts))


def lines_centroid(lines: Column) -> Column:
    """Length-weighted centroid of lines given as ``array<line<[x, y]>>``."""
    legs = F.flatten(F.transform(lines, lambda ln: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(ln) - 1, F.lit(1))), lambda i: let(
            F.struct(F.get(ln, i - 1).alias("a"), F.coalesce(F.get(ln, i), F.get(ln, i - 1)).alias("b")),
            lambda e: F.struct(F.hypot(e["b"][0] - e["a"][0], e["b"][1] - e["a"][1]).alias("w"),
                               vertex((e["a"][0] + e["b"][0]) / 2, (e["a"][1] + e["b"][1]) / 2).alias("c"))))))
    return let(legs, lambda parts: _weighted(parts))


def _weighted(parts: Column) -> Column:
    total = lambda f: F.aggregate(parts, F.lit(0.0), lambda s, p: s + f(p))
    return let(total(lambda p: p["w"]), lambda w: F.when(w > 0, vertex(
        total(lambda p: p["w"] * p["c"]["x"]) / w, total(lambda p: p["w"] * p["c"]["y"]) / w))
        .otherwise(F.get(parts, F.lit(0))["c"]))


# ---- point in polygon --------------------------------------------------------------------------

def in_convex(ring: Column, x, y, strict: bool = True) -> Column:
    """Inside a convex counter-clockwise ring; ``strict`` leaves the boundary out."""
    x, y = _c(x), _c(y)
    if strict:
        return F.forall(_edges(ring), lambda i: _side(_at(ring, i), F.get(ring, i), x, y) > 0)
    return F.forall(_edges(ring), lambda i: _side(_at(ring, i), F.get(ring, i), x, y) >= 0)


def on_boundary(ring: Column, x, y) -> Column:
    x, y = _c(x), _c(y)

    def hit(i):
        a, b = _at(ring, i), F.get(ring, i)
        return ((_side(a, b, x, y) == 0)
                & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
                & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])))

    return F.exists(_edges(ring), hit)


def in_polygon(ring: Column, x, y, strict: bool = True) -> Column:
    """Even-odd test for any simple ring."""
    x, y = _c(x), _c(y)

    def crosses(i):
        a, b = _at(ring, i), F.get(ring, i)
        return ((a["y"] > y) != (b["y"] > y)) & (
            x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])

    odd = F.aggregate(_edges(ring), F.lit(False), lambda s, i: s != crosses(i))
    edge = on_boundary(ring, x, y)
    return (odd & ~edge) if strict else (odd | edge)


def in_part(ring: Column, holes: Column, x, y) -> Column:
    """Strictly inside a ring and neither in nor on one of its holes."""
    return in_polygon(ring, x, y) & ~F.exists(holes, lambda h: in_polygon(h, x, y, strict=False))


def part_meets_box(ring: Column, holes: Column, box: tuple[float, float, float, float]) -> Column:
    """A polygon part, of any shape, shares a point with a closed envelope.

    Either one of its edges does (the edge's parameter interval inside the envelope is not empty), or it holds the
    envelope's corner and no hole does.
    """
    x0, y0, x1, y1 = map(float, box)

    def inside(start, step, low, high):
        """Interval of t in [0, 1] with low <= start + t * step <= high; (2, -1) if there is none."""
        fits, flat = start.between(low, high), step == 0
        a, b = (F.lit(low) - start) / F.nullif(step, F.lit(0.0)), (F.lit(high) - start) / F.nullif(step, F.lit(0.0))
        return (F.when(flat, F.when(fits, 0.0).otherwise(2.0)).otherwise(F.least(a, b)),
                F.when(flat, F.when(fits, 1.0).otherwise(-1.0)).otherwise(F.greatest(a, b)))

    def meets(pts, i):
        a, b = _at(pts, i), F.get(pts, i)
        (tx0, tx1), (ty0, ty1) = inside(a["x"], b["x"] - a["x"], x0, x1), inside(a["y"], b["y"] - a["y"], y0, y1)
        return F.greatest(tx0, ty0, F.lit(0.0)) <= F.least(tx1, ty1, F.lit(1.0))

    edge = lambda pts: F.exists(_edges(pts), lambda i: meets(pts, i))
    return edge(ring) | F.exists(holes, edge) | in_part(ring, holes, F.lit(x0), F.lit(y0))


def convex_meet(ring: Column, other: list[tuple[float, float]]) -> Column:
    """Two convex counter-clockwise rings share a point (separating axis test); ``other`` is closed."""
    lit = literal_ring(other)
    apart = F.exists(_edges(ring), lambda i: F.forall(
        lit, lambda q: _side(_at(ring, i), F.get(ring, i), q["x"], q["y"]) < 0))
    for (ax, ay), (bx, by) in zip(other, other[1:]):
        apart = apart | F.forall(ring, lambda p: (
            F.lit(bx - ax) * (p["y"] - F.lit(ay)) - F.lit(by - ay) * (p["x"] - F.lit(ax)) < 0))
    return ~apart


def part_meets_convex(ring: Column, holes: Column, area: list[tuple[float, float]]) -> Column:
    """A polygon part, of any shape, shares a point with a closed counter-clockwise convex ring ``area``.

    Either one of its edges does (the part of the edge inside all half planes of the ring is not empty), or the part holds the whole area.
    """
    planes = F.array(*[F.struct(F.lit(by - ay).alias("nx"), F.lit(ax - bx).alias("ny"), F.lit((by - ay) * ax + (ax - bx) * ay).alias("c"))
                       for (ax, ay), (bx, by) in zip(area, area[1:])])

    def meets(pts, i):
        a, b = _at(pts, i), F.get(pts, i)

        def cut(span, p):
            room, rate = p["c"] - p["nx"] * a["x"] - p["ny"] * a["y"], p["nx"] * (b["x"] - a["x"]) + p["ny"] * (b["y"] - a["y"])
            t = room / F.nullif(rate, F.lit(0.0))
            return F.struct(F.when(rate < 0, F.greatest(span["lo"], t)).when((rate == 0) & (room < 0), 2.0).otherwise(span["lo"]).alias("lo"),
                            F.when(rate > 0, F.least(span["hi"], t)).otherwise(span["hi"]).alias("hi"))

        return let(F.aggregate(planes, F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), cut), lambda s: s["lo"] <= s["hi"])

    edge = lambda pts: F.exists(_edges(pts), lambda i: meets(pts, i))
    return edge(ring) | F.exists(holes, edge) | in_part(ring, holes, F.lit(area[0][0]), F.lit(area[0][1]))


# ---- buffers -----------------------------------------------------------------------------------

def in_point_buffer(x, y, cx, cy, radius, quarter: int = 16) -> Column:
    """Inside (or on) the regular polygon that stands for a buffer of a point.

    The polygon has ``4 * quarter`` vertices on the circle, one of them due east.
    """
    dx, dy = _c(x) - _c(cx), _c(y) - _c(cy)
    r = _c(radius)
    step = math.pi / (2 * quarter)
    d = F.sqrt(dx * dx + dy * dy)
    turn = F.pmod(F.atan2(dy, dx), F.lit(step))
    return d * F.cos(turn - step / 2) <= r * math.cos(step / 2)


def point_buffer(x, y, radius: float, quarter: int = 16) -> Column:
    """Closed counter-clockwise ring around a point."""
    x, y = _c(x), _c(y)
    n = 4 * quarter
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: vertex(
        x + radius * F.cos(F.pmod(k, F.lit(n)) * (2 * math.pi / n)),
        y + radius * F.sin(F.pmod(k, F.lit(n)) * (2 * math.pi / n))))


def segment_buffer(p: Column, q: Column, radius: float, quarter: int = 16) -> Column:
    """Capsule around a segment: a half circle at each end, closed, counter-clockwise."""
    half = 2 * quarter
    turn = F.atan2(q["y"] - p["y"], q["x"] - p["x"])
    arc = lambda c, start: F.transform(F.sequence(F.lit(0), F.lit(half)), lambda k: vertex(
        c["x"] + radius * F.cos(start + k * (math.pi / half)),
        c["y"] + radius * F.sin(start + k * (math.pi / half))))
    around = F.concat(arc(q, turn - math.pi / 2), arc(p, turn + math.pi / 2))
    return F.concat(around, F.slice(around, 1, 1))


def to_mercator(lon, lat) -> tuple[Column, Column]:
    lon, lat = _c(lon), _c(lat)
    return F.radians(lon) * MERCATOR_R, F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * MERCATOR_R


def from_mercator(x, y) -> tuple[Column, Column]:
    x, y = _c(x), _c(y)
    return F.degrees(x / MERCATOR_R), F.degrees(F.atan(F.exp(y / MERCATOR_R)) * 2 - math.pi / 2)


def mercator_circle(lon: float, lat: float, radius_m: float, quarter: int = 8) -> list[tuple[float, float]]:
    """Search area: a buffer in Web-Mercator metres, back in degrees. One short literal, closed."""
    x0 = math.radians(lon) * MERCATOR_R
    y0 = math.log(math.tan(math.radians(lat) / 2 + math.pi / 4)) * MERCATOR_R
    out = []
    for k in range(4 * quarter):
        x = x0 + radius_m * math.cos(k * math.pi / (2 * quarter))
        y = y0 + radius_m * math.sin(k * math.pi / (2 * quarter))
        out.append((math.degrees(x / MERCATOR_R),
                    math.degrees(2 * math.atan(math.exp(y / MERCATOR_R)) - math.pi / 2)))
    return [*out, out[0]]


# ---- metres ------------------------------------------------------------------------------------

def metres_per_degree(lat) -> tuple[Column, Column]:
    """Local scale on the ellipsoid: (per degree of longitude, per degree of latitude)."""
    phi = F.radians(_c(lat))
    w = 1 - WGS84_E2 * F.sin(phi) * F.sin(phi)
    return (F.cos(phi) * WGS84_A / F.sqrt(w) * (math.pi / 180),
            WGS84_A * (1 - WGS84_E2) / (w * F.sqrt(w)) * (math.pi / 180))


def distance_to_ring(ring: Column, x, y) -> Column:
    """Metres from a point to a convex polygon, 0 inside; local plane at the point (within 1 m)."""
    kx, ky = metres_per_degree(y)
    at = F.struct(ring.alias("ring"), _c(x).alias("x"), _c(y).alias("y"), kx.alias("kx"), ky.alias("ky"))
    return let(at, _distance)


def _distance(at: Column) -> Column:
    ring, x, y, kx, ky = (at[k] for k in ("ring", "x", "y", "kx", "ky"))

    def to_edge(i):
        """Squared distance to one edge: |w - t u| with t clamped to the edge."""
        a, b = _at(ring, i), F.get(ring, i)
        legs = F.struct(((b["x"] - a["x"]) * kx).alias("ux"), ((b["y"] - a["y"]) * ky).alias("uy"),
                        ((x - a["x"]) * kx).alias("wx"), ((y - a["y"]) * ky).alias("wy"))

        def clamp(v):
            t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(
                v["wx"] * v["ux"] + v["wy"] * v["uy"], v["ux"] * v["ux"] + v["uy"] * v["uy"]), F.lit(0.0))))
            return let(F.struct((v["wx"] - t * v["ux"]).alias("dx"), (v["wy"] - t * v["uy"]).alias("dy")),
                       lambda d: d["dx"] * d["dx"] + d["dy"] * d["dy"])
        return let(legs, clamp)

    inside = in_convex(ring, x, y, strict=False) & (F.size(ring) > 3)
    return F.when(inside, 0.0).otherwise(F.sqrt(F.array_min(F.transform(_edges(ring), to_edge))))


def distance_to_edges(edges: Column, x: Column, y: Column) -> Column:
    """Metres from a point to the nearest of ``array<struct<ax, ay, bx, by>>``, in the local plane at the point; null without edges."""
    kx, ky = metres_per_degree(y)

    def far(at):
        def squared(e):
            legs = F.struct(((e["bx"] - e["ax"]) * at["kx"]).alias("ux"), ((e["by"] - e["ay"]) * at["ky"]).alias("uy"),
                            ((at["x"] - e["ax"]) * at["kx"]).alias("wx"), ((at["y"] - e["ay"]) * at["ky"]).alias("wy"))

            def clamp(v):
                t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(
                    v["wx"] * v["ux"] + v["wy"] * v["uy"], v["ux"] * v["ux"] + v["uy"] * v["uy"]), F.lit(0.0))))
                return let(F.struct((v["wx"] - t * v["ux"]).alias("dx"), (v["wy"] - t * v["uy"]).alias("dy")),
                           lambda d: d["dx"] * d["dx"] + d["dy"] * d["dy"])
            return let(legs, clamp)
        return F.sqrt(F.array_min(F.transform(edges, squared)))
    return let(F.struct(x.alias("x"), y.alias("y"), kx.alias("kx"), ky.alias("ky")), far)


def geodesic(lon1, lat1, lon2, lat2) -> Column:
    """Ellipsoidal distance in metres (Andoyer-Lambert closed form)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half = lambda c: F.pow(F.sin(c), 2)
    return let(F.struct(half((p1 + p2) / 2).alias("f"), half((p1 - p2) / 2).alias("g"),
                        half((F.radians(_c(lon1)) - F.radians(_c(lon2))) / 2).alias("l")), _lambert)


def _lambert(h: Column) -> Column:
    """From the squared sines of mean latitude, half latitude difference, half longitude difference."""
    sf, sg, sl = h["f"], h["g"], h["l"]
    cf, cg, cl = 1 - sf, 1 - sg, 1 - sl
    sc = F.struct((sg * cl + cf * sl).alias("s"), (cg * cl + sf * sl).alias("c"))

    def arc(v):
        w = F.atan(F.sqrt(v["s"] / v["c"]))
        return F.when(v["s"] == 0, 0.0).otherwise(let(
            F.struct(w.alias("w"), (F.sqrt(v["s"] * v["c"]) / w).alias("r")),
            lambda a: 2 * a["w"] * WGS84_A * (1 + WGS84_F * ((3 * a["r"] - 1) / (2 * v["c"]) * sf * cg
                                                             - (3 * a["r"] + 1) / (2 * v["s"]) * cf * sg))))
    return let(sc, arc)


def geodesic_box(lon: float, lat: float, metres: float) -> tuple[float, float, float, float]:
    """Envelope that surely holds every point within ``metres`` (for pushdown before ``geodesic``)."""
    dlat = metres / 110_000.0
    edge = min(abs(lat) + dlat, 89.0)
    dlon = metres / (110_000.0 * math.cos(math.radians(edge)))
    return lon - dlon, lat - dlat, lon + dlon, lat + dlat


# ---- text forms --------------------------------------------------------------------------------

def wkt_polygon(ring: Column) -> Column:
    pts = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(pts, ", "), F.lit("))"))


def poly_filter(ring: Column) -> Column:
    """``poly:"lat lon lat lon .."`` filter text of the OSM query language."""
    pts = F.transform(ring, lambda p: F.concat_ws(" ", p["y"].cast("string"), p["x"].cast("string")))
    return F.concat(F.lit('poly:"'), F.array_join(pts, " "), F.lit('"'))


def geojson_polygon(ring: Column) -> Column:
    pairs = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    return F.struct(F.lit("Polygon").alias("type"), F.array(pairs).alias("coordinates"))


def geojson_point(x, y) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(_c(x), _c(y)).alias("coordinates"))
