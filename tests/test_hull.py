"""Hulls: exact turns, the same ring however points are dealt, points far inside dropped before Python."""

import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from stormgrid.operators import hull


def test_turns_are_exact():
    rng = random.Random(4)
    for _ in range(2000):
        a = (rng.uniform(-90, 90), rng.uniform(-90, 90))
        d, s, t = (rng.uniform(-1, 1), rng.uniform(-1, 1)), rng.random(), rng.random()
        b, c = (a[0] + s * d[0], a[1] + s * d[1]), (a[0] + t * d[0], a[1] + t * d[1])
        det = (Fraction(b[0]) - Fraction(a[0])) * (Fraction(c[1]) - Fraction(a[1])) - (
            Fraction(b[1]) - Fraction(a[1])) * (Fraction(c[0]) - Fraction(a[0]))
        assert hull.turn(a, b, c) == (det > 0) - (det < 0)


def _cloud(rng, n, kind):
    if kind == "disc":
        return [(-85 + r * np.cos(t), 38 + r * np.sin(t)) for r, t in ((rng.random() ** 0.5, rng.uniform(0, 7)) for _ in range(n))]
    if kind == "grid":
        return [(rng.randrange(40) / 10, rng.randrange(40) / 10) for _ in range(n)]
    if kind == "line":
        return [(t / 7, t / 3) for t in (rng.randrange(1000) for _ in range(n))]
    if kind == "circle":
        return [(np.cos(i), np.sin(i)) for i in range(n)]
    return [(1.5, 2.5)] * n


def test_same_ring_however_points_are_dealt(spark):
    rng = random.Random(9)
    rows = [(k, float(x), float(y)) for k in ("disc", "grid", "line", "circle", "copies") for x, y in _cloud(rng, 3000, k)]
    rows += [("two", 0.0, 0.0), ("two", 1.0, 1.0), (None, 3.0, 3.0), ("disc", None, 1.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, lon double, lat double")
    seen = [{r.k: (r.hull_kind, [tuple(p) for p in r.ring]) for r in hull.convex_hulls(part, ["k"]).collect()}
            for part in (df, df.repartition(7), df.coalesce(1).sort("lat"))]
    assert seen[0] == seen[1] == seen[2]
    assert {k: v[0] for k, v in seen[0].items()} == {
        "disc": "polygon", "grid": "polygon", "line": "line", "circle": "polygon", "copies": "point", "two": "line"}
    for k in ("disc", "grid", "circle"):
        pts = np.array([(x, y) for key, x, y in rows if key == k and x is not None])
        assert seen[0][k][1][:-1] == [tuple(p) for p in hull.hull_points(pts)]
    assert len(seen[0]["circle"][1]) == 3001


def test_points_inside_are_dropped_in_the_plan(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i % 2, *map(float, p)) for i, p in enumerate(_cloud(rng, 20_000, "disc"))], "k int, px double, py double")
    supports = hull._supports(df, ["k"])
    left = hull._outer(df, supports, ["k"])
    assert left.count() < 3000
    plan = supports.sparkSession._jvm.PythonSQLUtils.explainString(left._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "Arrow" not in plan
    assert {r.n for r in supports.select(F.col("n")).collect()} == {10_000}


def test_keys_of_few_points_need_no_supports(spark, monkeypatch):
    """Many short keys go without the sixteen directions; long ones beside them have the same hulls as before."""
    rng = random.Random(8)
    asked, supports = [], hull._supports
    monkeypatch.setattr(hull, "_supports", lambda points, keys: asked.append(points.select(*keys).distinct().count()) or supports(points, keys))
    rows = [(k, rng.randrange(9) / 1e6, rng.randrange(9) / 1e6) for k in range(30) for _ in range(1 + k % 7)]
    ring = lambda df: {r.k: [tuple(p) for p in r.ring[:-1]] for r in hull.convex_hulls(df, ["k"]).collect()}
    want = lambda rows, k: hull.settled(hull.exact_hull([(x, y) for j, x, y in rows if j == k]))
    assert ring(spark.createDataFrame(rows, "k int, lon double, lat double")) == {k: want(rows, k) for k in range(30)} and asked == []
    rows += [(k, rng.random(), rng.random()) for k in (40, 41) for _ in range(700)]
    assert ring(spark.createDataFrame(rows, "k int, lon double, lat double")) == {k: want(rows, k) for k in [*range(30), 40, 41]} and asked == [2]


def test_sql_hull_of_a_group_skips_missing_points(spark):
    from stormgrid.functions import sql
    sql.register(spark)
    spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 0.0), (1, 1.0, 1.0), (1, None, 5.0), (1, float("nan"), 5.0), (None, 2.0, 3.0), (2, None, None)],
                          "k int, x double, y double").createOrReplaceTempView("some_points")
    found = spark.sql("SELECT k, sg_hull(x, y) AS h FROM some_points GROUP BY k")
    assert {r.k: [tuple(p) for p in r.h] for r in found.collect()} == {1: [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], None: [(2.0, 3.0)], 2: []}
    assert "pandas" not in sql._hull.__annotations__["x"]    # a pandas frame per group costs four times as much
