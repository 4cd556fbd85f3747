import math

import numpy as np
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.operators import gridjoin
from stormgrid.operators.hull import convex_hulls, hull_points, solid

SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first().asDict()


def test_measures_and_membership(spark):
    sq = geo.literal_ring(SQUARE)
    lshape = geo.literal_ring([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)])
    got = one(spark, area=geo.area(sq), c=geo.centroid(sq), la=geo.area(lshape),
              inside=geo.in_convex(sq, 1, 1), edge=geo.in_convex(sq, 2, 1), touch=geo.in_convex(sq, 2, 1, False),
              out=geo.in_convex(sq, 3, 1, False), l_in=geo.in_polygon(lshape, 0.5, 1.5),
              l_out=geo.in_polygon(lshape, 1.5, 1.5), l_edge=geo.in_polygon(lshape, 1, 1.5),
              l_touch=geo.in_polygon(lshape, 1, 1.5, False),
              meets=geo.convex_meet(sq, [(2, 2), (3, 2), (3, 3), (2, 2)]),
              apart=geo.convex_meet(sq, [(2.1, 2), (3, 2), (3, 3), (2.1, 2)]))
    assert got["area"] == 4 and (got["c"].x, got["c"].y) == (1, 1) and got["la"] == 3
    assert [got[k] for k in ("inside", "edge", "touch", "out", "l_in", "l_out", "l_edge", "l_touch", "meets", "apart")] \
        == [True, False, True, False, True, False, False, True, True, False]


def test_metres(spark):
    # WGS84: one degree along the equator is 111319.491 m; pole to equator quarter arcs are near 10001.966 km
    got = one(spark, eq=geo.geodesic(0, 0, 1, 0), same=geo.geodesic(5, 5, 5, 5),
              par=geo.geodesic(-85.76, 38.25, -85.76, 38.35),
              ring=geo.distance_to_ring(geo.literal_ring([(-85.7, 38.2), (-85.6, 38.2), (-85.6, 38.4), (-85.7, 38.4), (-85.7, 38.2)]), -85.71, 38.3),
              inside=geo.distance_to_ring(geo.literal_ring(SQUARE), 1, 1))
    assert abs(got["eq"] - 111319.491) < 0.01 and got["same"] == 0 and got["inside"] == 0
    assert abs(got["par"] - 11100.9) < 1.0
    n = geo.WGS84_A / math.sqrt(1 - geo.WGS84_E2 * math.sin(math.radians(38.3)) ** 2)
    assert abs(got["ring"] - n * math.cos(math.radians(38.3)) * math.radians(0.01)) < 0.5


def test_buffers_are_the_polygon_not_the_circle(spark):
    r = np.random.default_rng(1)
    pts = [(float(a), float(b)) for a, b in r.normal(0, 1, (400, 2))]
    pts = [(x / math.hypot(x, y) * (0.997 + 0.004 * i / 400), y / math.hypot(x, y) * (0.997 + 0.004 * i / 400)) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(pts, "x double, y double")
    rows = df.select(geo.in_point_buffer("x", "y", 0, 0, 1).alias("a"),
                     geo.in_convex(geo.point_buffer(F.lit(0.0), F.lit(0.0), 1.0), F.col("x"), F.col("y"), False).alias("b")).collect()
    assert all(a.a == a.b for a in rows) and {a.a for a in rows} == {True, False}


def test_mercator_round_trip(spark):
    mx, my = geo.to_mercator(-85.7585, 38.2527)
    back = geo.from_mercator(mx, my)
    got = one(spark, x=back[0], y=back[1])
    assert abs(got["x"] + 85.7585) < 1e-9 and abs(got["y"] - 38.2527) < 1e-9
    ring = geo.mercator_circle(-85.7585, 38.2527, 40_000)
    assert len(ring) == 33 and ring[0] == ring[-1]


def test_hulls_match_brute_force_and_hold_their_points(spark):
    r = np.random.default_rng(3)
    rows = [(int(k), float(x), float(y)) for k, x, y in zip(r.integers(0, 20, 4000), r.random(4000), r.random(4000))]
    rows += [(100, 1.0, 1.0)] * 3 + [(101, 0.0, 0.0), (101, 1.0, 1.0), (101, 0.5, 0.5)] + [(102, None, 1.0)]
    rows += [(103, float(a), float(b)) for a, b in r.normal(0, 1, (30000, 2))]
    df = spark.createDataFrame(rows, "k long, lon double, lat double").repartition(3)
    got = {x.k: x for x in convex_hulls(df, ["k"]).withColumn("full", solid()).withColumn("area", geo.area(F.col("full"))).collect()}
    assert 102 not in got
    assert got[100].hull_kind == "point" and len(got[100].full) == 65
    assert got[101].hull_kind == "line" and [tuple(p) for p in got[101].ring[:2]] == [(0, 0), (1, 1)]
    assert got[101].area > 2e-6 and got[100].area > 3e-12
    for k in [*range(20), 103]:
        pts = np.array([(x, y) for a, x, y in rows if a == k])
        ring = [tuple(p) for p in got[k].ring]
        assert ring[:-1] == [tuple(p) for p in hull_points(pts)] and ring[0] == ring[-1]
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            assert ((bx - ax) * (pts[:, 1] - ay) - (by - ay) * (pts[:, 0] - ax) > -1e-12).all()


def test_grid_join_equals_nested_loop(spark):
    r = np.random.default_rng(4)
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(r.random((800, 2)) * 4 - 2)], "id long, lon double, lat double")
    polys = []
    for i in range(60):
        cx, cy = r.random(2) * 4 - 2
        s = float(10 ** r.uniform(-3, 0.3))
        polys.append((i, [(float(cx - s), float(cy - s)), (float(cx + s), float(cy - s)), (float(cx + s), float(cy + s)), (float(cx - s), float(cy + s)), (float(cx - s), float(cy - s))]))
    pdf = spark.createDataFrame(polys, f"pid long, ring {geo.RING}").withColumns(geo.bounds(F.col("ring")))
    test = geo.in_convex(F.col("ring"), F.col("lon"), F.col("lat"))
    pairs = {(a.id, a.pid) for a in gridjoin.points_in_polygons(pts, pdf, test).collect()}
    want = {(p.id, i) for p in pts.collect() for i, q in polys if q[0][0] < p.lon < q[1][0] and q[0][1] < p.lat < q[2][1]}
    assert pairs == want and len(want) > 100
    some = [a.id for a in gridjoin.points_in_any(pts, pdf, test, "id").collect()]
    assert sorted(some) == sorted({p for p, _ in want})
