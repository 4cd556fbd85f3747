"""Area and centroid of the union of overlapping polygons: what several cover counts once.

Polygons are cut by the cells of one grid, about as wide as they are. A cell that lies inside any polygon is covered as a whole. In any
other cell the plane between two neighbouring heights at which anything changes (an end of an edge, a crossing of two edges, or
of an edge with the cell's sides) is covered by trapezoids, whose sums are exact. A cell with many edges is cut into
smaller ones first, so a task's work follows ``MOST`` and not how many polygons lie in one place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import cellindex

MOST = 400              # edges of a cell that are settled as they are
_SPLIT = 2              # a busy cell is cut into 4 x 4: two levels of the grid
_FINEST = -24           # cells of 6e-8 degrees are settled whatever they hold
_SUMS = "area double, mx double, my double"


def _cover(polys: DataFrame, level: int) -> DataFrame:
    side = 2.0 ** level
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    cells = polys.withColumn("_gx", span("xmin", "xmax")).withColumn("_gy", span("ymin", "ymax")).withColumn("_lv", F.lit(level))
    return _narrowed(cells)


def _narrowed(cells: DataFrame) -> DataFrame:
    return cellindex.narrowed(cells, ["_pid"])


def _settled(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of one cell: area and its first moments about the origin."""
    side = 2.0 ** int(pdf["_lv"].iloc[0])
    x0, y0 = float(pdf["_gx"].iloc[0]) * side, float(pdf["_gy"].iloc[0]) * side
    # relative to the cell's corner, in units of its side
    rings = [(np.array([(e["ax"], e["ay"], e["bx"], e["by"]) for e in edges]) - (x0, y0, x0, y0)) / side for edges in pdf["_edges"]]
    area, mx, my = covered(rings)
    return pd.DataFrame({"area": [area * side ** 2], "mx": [(mx * side + area * x0) * side ** 2],
                         "my": [(my * side + area * y0) * side ** 2]})


def covered(rings: list[np.ndarray]) -> tuple[float, float, float]:
    """Area and first moments of what the ``rings``, edges ``(ax, ay, bx, by)`` each, cover of the unit square (even-odd each)."""
    e = np.concatenate(rings)
    of = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    flat = e[:, 1] == e[:, 3]
    e, of = e[~flat], of[~flat]
    if not len(e):
        return 0.0, 0.0, 0.0
    up = e[:, 1] < e[:, 3]
    e = np.where(up[:, None], e, e[:, [2, 3, 0, 1]])
    slope = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    base = e[:, 0] - slope * e[:, 1]                    # x = base + slope * y
    with np.errstate(divide="ignore", invalid="ignore"):
        meet = (base[None, :] - base[:, None]) / (slope[:, None] - slope[None, :])
        sides = [(edge - base) / slope for edge in (0.0, 1.0)]
    inside = np.isfinite(meet) & (meet >= np.maximum(e[:, None, 1], e[None, :, 1])) & (meet <= np.minimum(e[:, None, 3], e[None, :, 3]))
    heights = np.concatenate([[0.0, 1.0], e[:, 1], e[:, 3], meet[np.triu(inside, 1)], *sides])
    heights = np.unique(heights[np.isfinite(heights) & (heights >= 0) & (heights <= 1)])
    area = mx = my = 0.0
    for lo, hi in zip(heights[:-1], heights[1:]):
        mid = (lo + hi) / 2
        live = np.flatnonzero((e[:, 1] <= lo) & (e[:, 3] >= hi))
        live = live[np.argsort(base[live] + slope[live] * mid, kind="stable")]
        odd, count, begin = np.zeros(len(rings), bool), 0, None
        # edges left of the square are not all there: the count is taken from the right, where it is zero
        for i in live[::-1].tolist():
            odd[of[i]] ^= True
            count += 1 if odd[of[i]] else -1
            if count and begin is None:
                begin = i
            elif not count:
                a, b, c = _strip(base, slope, i, begin, lo, mid, hi)
                area, mx, my, begin = area + a, mx + b, my + c, None
        if begin is not None:
            a, b, c = _strip(base, slope, None, begin, lo, mid, hi)
            area, mx, my = area + a, mx + b, my + c
    return area, mx, my


def _strip(base, slope, left, right, lo, mid, hi):
    """Sums of the trapezoid between two edges, cut off at the sides of the square; Simpson's rule is exact here."""
    out = np.zeros(3)
    for y, w in ((lo, 1 / 6), (mid, 4 / 6), (hi, 1 / 6)):
        r = min(1.0, max(0.0, base[right] + slope[right] * y))
        l = 0.0 if left is None else min(1.0, max(0.0, base[left] + slope[left] * y))
        out += w * np.array([r - l, (r * r - l * l) / 2, y * (r - l)])
    return out * (hi - lo)


def union_centroid(shapes: DataFrame) -> DataFrame:
    """``(area, lon, lat)`` of the union of ``shapes(ring[, holes], xmin, ymin, xmax, ymax)``; nulls and area 0 without any.

    Equal polygons count as one from the start.
    """
    rings = cellindex._rings(shapes)
    polys = shapes.where(F.size("ring") > 3).select("xmin", "ymin", "xmax", "ymax", rings.alias("r")).dropDuplicates(["r"])
    polys = staged(polys.select("xmin", "ymin", "xmax", "ymax", cellindex.edges(F.col("r")).alias("_edges"),
                                F.monotonically_increasing_id().alias("_pid")), "union-polygons")
    extent = polys.agg(F.avg(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).first()[0]
    if not extent:
        return polys.agg(F.lit(0.0).alias("area"), F.max("xmin").alias("lon"), F.max("ymin").alias("lat")).select(
            "area", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"))
    cells, level = _cover(polys, math.ceil(math.log2(extent))), math.ceil(math.log2(extent))
    key, done = ["_lv", "_gx", "_gy"], None
    while True:
        cells = staged(cells, "union-cells")
        load = cells.groupBy(*key).agg(F.bool_or("_inner").alias("full"), F.sum(F.size("_edges")).alias("n"))
        side = F.pow(F.lit(2.0), F.col("_lv").cast("double"))
        mid = lambda g: (F.col(g) + 0.5) * side
        whole = load.where("full").select((side * side).alias("area"), (mid("_gx") * side * side).alias("mx"),
                                          (mid("_gy") * side * side).alias("my"))
        final = F.lit(level <= _FINEST) | (F.col("n") <= MOST)
        open_ = load.where(~F.col("full")).select(*key, final.alias("final"))
        rest = cells.join(open_, key)
        sums = whole.unionByName(rest.where("final").groupBy(*key).applyInPandas(_settled, _SUMS))
        done = sums if done is None else done.unionByName(sums)
        busy = rest.where(~F.col("final"))
        if busy.isEmpty():
            break
        level -= _SPLIT
        step = 1 << _SPLIT
        inner = lambda g: F.explode(F.transform(F.sequence(F.lit(0), F.lit(step - 1)), lambda k: F.col(g) * step + k))
        cells = _narrowed(busy.withColumn("_gx", inner("_gx")).withColumn("_gy", inner("_gy")).withColumn("_lv", F.lit(level)))
    return done.agg(F.sum("area").alias("area"), (F.sum("mx") / F.sum("area")).alias("lon"), (F.sum("my") / F.sum("area")).alias("lat"))
