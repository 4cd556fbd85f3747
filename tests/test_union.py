"""Unions of overlapping polygons: known shapes, rectangles counted by unit squares, triangles by a fine raster."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.operators import union


def frame(spark, rings):
    rows = [([{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]],) for r in rings]
    return spark.createDataFrame(rows, "ring array<struct<x:double,y:double>>").withColumns(geo.bounds(F.col("ring")))


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_rectangles_by_unit_squares(spark):
    rng = random.Random(2)
    rects = [(rng.randint(0, 40), rng.randint(0, 30), rng.randint(1, 12), rng.randint(1, 9)) for _ in range(120)]
    units = {(x + i, y + j) for x, y, w, h in rects for i in range(w) for j in range(h)}
    got = union.union_centroid(frame(spark, [box(*r) for r in rects] * 2)).first()
    assert got.area == pytest.approx(len(units))
    assert (got.lon, got.lat) == pytest.approx(tuple(np.mean([(x + .5, y + .5) for x, y in units], 0)))


def test_triangles_by_raster():
    rng = np.random.default_rng(5)
    tri = rng.uniform(-0.3, 1.3, size=(9, 3, 2))
    at = (np.arange(1200) + .5) / 1200
    x, y = np.meshgrid(at, at)
    hit = np.zeros_like(x, bool)
    rings = []
    for t in tri:
        sides = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(t, np.roll(t, -1, 0))]
        hit |= np.all([s > 0 for s in sides], 0) | np.all([s < 0 for s in sides], 0)
        rings.append(np.array([(*a, *b) for a, b in zip(t, np.roll(t, -1, 0))]))
    area, mx, my = union.covered(rings)
    assert area == pytest.approx(hit.mean(), abs=2e-3)
    assert (mx / area, my / area) == pytest.approx((x[hit].mean(), y[hit].mean()), abs=2e-3)


def test_busy_place_is_cut_up(spark, monkeypatch):
    monkeypatch.setattr(union, "MOST", 30)
    turned = [[(0, 0), (4 + i / 10, 1), (3, 4 + i / 7)] for i in range(40)] + [box(8, 8, 1, 1)]
    many = union.union_centroid(frame(spark, turned)).first()
    monkeypatch.setattr(union, "MOST", 10_000)
    few = union.union_centroid(frame(spark, turned)).first()
    assert tuple(many) == pytest.approx(tuple(few))


def test_no_polygons(spark):
    got = union.union_centroid(frame(spark, [box(0, 0, 1, 1)]).where("false")).first()
    assert got.area == 0 and got.lon is None
