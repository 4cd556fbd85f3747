"""The cell index against brute force on rows of its own; the work of the parts is dealt to all cores."""

import random

import pytest
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.operators import cellindex

RING = "array<struct<x:double,y:double>>"


def closed(points):
    return [*points, points[0]]


@pytest.fixture(scope="module")
def polys(spark):
    """Parts of several sizes, not convex, some with a hole, one twice, one without a ring."""
    rng, rows = random.Random(3), []
    for k in range(40):
        s, x, y = rng.choice([0.004, 0.05, 0.8]), rng.uniform(-2, 2), rng.uniform(40, 42)
        ring = closed([(x, y), (x + 4 * s, y), (x + 4 * s, y + 4 * s), (x + 3 * s, y + 4 * s), (x + 3 * s, y + s), (x + s, y + s),
                       (x + s, y + 4 * s), (x, y + 4 * s)])
        hole = closed([(x + 0.2 * s, y + 0.2 * s), (x + 0.2 * s, y + 0.8 * s), (x + 0.8 * s, y + 0.8 * s), (x + 0.8 * s, y + 0.2 * s)])
        rows.append((k, ring, [hole] if k % 2 else None))
    rows += [rows[1], (99, None, None)]
    return spark.createDataFrame(rows, f"k int, ring {RING}, holes array<{RING}>").coalesce(1).withColumns(geo.bounds(F.col("ring")))


@pytest.fixture(scope="module")
def points(spark, polys):
    rng = random.Random(4)
    at = [(p.x, p.y) for r in polys.where("ring is not null").collect() for p in r.ring]
    near = [(x + rng.uniform(-0.004, 0.004), y + rng.uniform(-0.004, 0.004)) for x, y in at for _ in range(3)]
    far = [(rng.uniform(-2, 4), rng.uniform(40, 45)) for _ in range(400)]
    rows = [(i % 900, x, y) for i, (x, y) in enumerate([*at, *near, *far])] + [(None, *near[0]), (5, None, 41.0)]
    return spark.createDataFrame(rows, "id long, lon double, lat double")


def pairs(points, polys):
    return points.where("lon is not null").crossJoin(polys.where("ring is not null"))


def test_inside(points, polys):
    holes = F.coalesce("holes", F.slice(F.array("ring"), 1, 0))
    want = pairs(points, polys).where(geo.in_part(F.col("ring"), holes, "lon", "lat")).select("id", "lon", "lat", "k").collect()
    got = cellindex.inside(points, polys, ["k"]).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert len(want) > 300 and sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_near(points, polys):
    rings = cellindex.edges(cellindex._rings(polys))
    d = F.when(cellindex.odd(F.col("e"), F.col("lon"), F.col("lat")), 0.0).otherwise(
        geo.distance_to_edges(F.col("e"), F.col("lon"), F.col("lat")))
    want = pairs(points, polys).withColumn("e", rings).withColumn("d", d).where("d <= 150").select("id", "lon", "lat", "k", "d").collect()
    got = cellindex.near(points, polys, ["k"], 150.0).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert len(want) > 300 and sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_convex(spark, points):
    rows = [(k, closed([(x, 40.5), (x + s, 40.5), (x + s, 40.5 + s), (x, 40.5 + s)])) for k, (x, s) in enumerate([(-1.9, 0.5), (0.0, 1.5), (0.1, 0.01)])]
    boxes = spark.createDataFrame(rows, f"k int, ring {RING}").withColumns(geo.bounds(F.col("ring")))
    want = pairs(points, boxes).where(geo.in_convex(F.col("ring"), "lon", "lat")).count()
    assert cellindex.inside(points, boxes, ["k"], convex=True).count() == want > 50


def test_small_chunks(points, polys, monkeypatch):
    whole = cellindex.index(polys, ["k"])
    monkeypatch.setattr(cellindex, "_MOST", 50)
    assert sorted(map(str, cellindex.index(polys, ["k"]).collect())) == sorted(map(str, whole.collect()))


def test_no_polygons(points, polys):
    assert cellindex.inside(points, polys.limit(0), ["k"]).count() == 0 == cellindex.near(points, polys.where("k = 99"), ["k"], 9.0).count()


def test_parts_are_dealt_to_all_cores(polys):
    """One file of one row group (or one split) must not put all cells into one task."""
    assert polys.rdd.getNumPartitions() == 1
    assert len(cellindex.index(polys, ["k"]).inputFiles()) > 1
