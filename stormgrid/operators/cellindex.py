"""Points against polygons of any shape through an index of grid cells.

A polygon part, with its holes, is listed under the at most 36 cells that its envelope covers on a level that fits its size. A cell
that no edge crosses lies inside or outside as a whole: outside it is not listed, inside it needs no further test. Any other
cell carries only the edges that the test of a point in it can depend on: those of its strip that do not lie to its left (even-odd
rule), those that cross it (convex rings), or those within reach (distance).

Points are met once, as id and coordinates. Where polygons of several sizes are in use, the occupied cells of the finest
level are looked up in all levels instead of the points, and take over what the larger cells carry, narrowed to themselves.

What a cell needs is told for a batch of cells at once, on arrays of their edges; the parts are dealt to all cores first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geo
from ..session import dealt, staged
from .gridjoin import degree_pads, ranges

_KEY = ["_lv", "_gx", "_gy"]
_SPAN = ["_lv", "_gx0", "_gx1", "_gy0", "_gy1"]
_MOST = 1 << 19         # edges tested at once
_SLACK = 1.5e-13        # rounding of a side test per unit of edge length: coordinates up to 360


# edges ---------------------------------------------------------------------------------------------------------------

def edges(rings: Column) -> Column:
    """``array<struct<ax, ay, bx, by>>`` of closed rings."""
    def of(ring):
        return F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p, i: F.struct(
            p["x"].alias("ax"), p["y"].alias("ay"), F.get(ring, i + 1)["x"].alias("bx"), F.get(ring, i + 1)["y"].alias("by")))
    return F.flatten(F.transform(rings, of))


def side(e: Column, x: Column, y: Column) -> Column:
    return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])


def odd(some: Column, x: Column, y: Column) -> Column:
    """An odd number of edges crosses the ray to the right."""
    def crosses(e):
        return ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])
    return F.aggregate(some, F.lit(False), lambda s, e: s != crosses(e))


def on_any(some: Column, x: Column, y: Column) -> Column:
    return F.exists(some, lambda e: (side(e, x, y) == 0) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
                    & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])))


# what a cell needs ---------------------------------------------------------------------------------------------------

class _Edges:
    """A column of edge lists as arrays; ``of(rows)`` gives those of chosen rows, with the place of the row each belongs to."""

    def __init__(self, lists: pa.ListArray):
        self.flat = lists.flatten()
        self.size = lists.value_lengths().to_numpy()
        self.start = np.cumsum(self.size) - self.size
        self.ends = {c: self.flat.field(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")}

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
        n = self.size[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(owner)) + np.repeat(self.start[rows] - (np.cumsum(n) - n), n)
        return owner, at, {c: v[at] for c, v in self.ends.items()}

    def lists(self, at: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), self.flat.take(pa.array(at)))


def _crossing(e: dict, x0, y0, x1, y1) -> np.ndarray:
    """An edge may meet a cell: its envelope does, and not all corners lie clearly on one side."""
    out = ((np.minimum(e["ax"], e["bx"]) <= x1) & (np.maximum(e["ax"], e["bx"]) >= x0)
           & (np.minimum(e["ay"], e["by"]) <= y1) & (np.maximum(e["ay"], e["by"]) >= y0))
    k = np.flatnonzero(out)
    near = {c: v[k] for c, v in e.items()}
    sides = [side(near, x[k], y[k]) for x in (x0, x1) for y in (y0, y1)]
    slack = (np.abs(near["bx"] - near["ax"]) + np.abs(near["by"] - near["ay"])) * _SLACK
    out[k] = (np.minimum.reduce(sides) <= slack) & (np.maximum.reduce(sides) >= -slack)
    return out


def _strip(e: dict, x0, y0, y1) -> np.ndarray:
    """Edges that a ray to the right from a point of the cell, or a test of lying on the boundary, can meet."""
    return (np.minimum(e["ay"], e["by"]) <= y1) & (np.maximum(e["ay"], e["by"]) >= y0) & (np.maximum(e["ax"], e["bx"]) >= x0 - 1e-9)


def _crosses(e: dict, x, y) -> np.ndarray:
    out = (e["ay"] > y) != (e["by"] > y)
    k = np.flatnonzero(out)
    ax, ay, bx, by = (e[c][k] for c in ("ax", "ay", "bx", "by"))
    out[k] = x[k] < (bx - ax) * (y[k] - ay) / (by - ay) + ax
    return out


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, ``_gx`` and ``_gy`` of every cell that a batch of parts is listed under."""
    x0, x1, y0, y1 = (batch.column(c).to_numpy() for c in _SPAN[1:])
    tall = y1 - y0 + 1
    n = (x1 - x0 + 1) * tall
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, x0[row] + k // tall[row], y0[row] + k % tall[row]


def _fitted(parts: DataFrame, keys: list[str], convex: bool = False, pad_y: float | None = None) -> DataFrame:
    """Parts ``(keys.., _lv, _gx0, _gx1, _gy0, _gy1, _edges)`` -> their cells not outside as a whole ``(keys.., _lv, _gx, _gy, _inner, _edges)``.

    With ``pad_y``, also ``_px`` and ``_near``: the padding and the edges whose distance may count.
    """
    reach = [] if pad_y is None else ["_px", "_near"]
    have = parts.schema
    schema = StructType([have[k] for k in keys]).add(have["_lv"]).add("_gx", "long").add("_gy", "long").add("_inner", "boolean").add(have["_edges"])
    for c in reach:
        schema.add(have[c])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = _Edges(b.column("_edges"))
            close = some if pad_y is None else _Edges(b.column("_near"))
            side_of = 2.0 ** b.column("_lv").to_numpy().astype(float)
            row, gx, gy = _cells(b)
            load = np.cumsum(np.maximum(some.size, close.size)[row])
            cuts = np.searchsorted(load, np.arange(_MOST, load[-1] if len(load) else 0, _MOST)).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(row)]):
                if lo < hi:
                    yield told(b, some, close, row[lo:hi], gx[lo:hi], gy[lo:hi], side_of[row[lo:hi]])

    def told(b, some, close, row, gx, gy, s) -> pa.RecordBatch:
        x0, y0, x1, y1 = gx * s, gy * s, (gx + 1) * s, (gy + 1) * s
        px, py = (0.0, 0.0) if pad_y is None else (b.column("_px").to_numpy()[row], pad_y)
        own, at, e = close.of(row)
        hit = _crossing(e, (x0 - px)[own], (y0 - py)[own], (x1 + px)[own], (y1 + py)[own])
        touched = np.bincount(own[hit], minlength=len(row)) > 0
        near = own, at, hit
        if close is not some:
            own, at, e = some.of(row)
        cx, cy = ((x0 + x1) / 2)[own], ((y0 + y1) / 2)[own]
        inside = (np.bincount(own[~(side(e, cx, cy) > 0)], minlength=len(row)) == 0 if convex
                  else np.bincount(own[_crosses(e, cx, cy)], minlength=len(row)) % 2 == 1)
        keep = np.flatnonzero(touched | inside)
        need = (hit if convex else _strip(e, x0[own], y0[own], y1[own])) & touched[own]
        taken = lambda which, own, at, mask: which.lists(at[mask], np.bincount(own[mask], minlength=len(row))[keep])
        rows = pa.array(row[keep])
        cols = [*(b.column(k).take(rows) for k in [*keys, "_lv"]), pa.array(gx[keep]), pa.array(gy[keep]), pa.array(~touched[keep]),
                taken(some, own, at, need)]
        if reach:
            cols += [b.column("_px").take(rows), taken(close, *near)]
        return pa.RecordBatch.from_arrays(cols, names=schema.names)

    return parts.where(" and ".join(f"{c} is not null" for c in [*_SPAN, "_edges"])).select(*keys, *_SPAN, "_edges", *reach).mapInArrow(run, schema)


def narrowed(cells: DataFrame, keys: list[str], convex: bool = False, pad_y: float | None = None) -> DataFrame:
    """Single cells ``_lv, _gx, _gy`` -> those not outside as a whole, with the edges they need."""
    return _fitted(cells.withColumns({f"{g}{i}": F.col(g) for g in ("_gx", "_gy") for i in (0, 1)}), keys, convex, pad_y)


# the index -----------------------------------------------------------------------------------------------------------

def _rings(polys: DataFrame) -> Column:
    rings = F.array("ring")
    return F.concat(rings, F.coalesce("holes", F.slice(rings, 1, 0))) if "holes" in polys.columns else rings


def index(polys: DataFrame, keys: list[str], convex: bool = False) -> DataFrame:
    """Stored ``(keys.., _lv, _gx, _gy, _inner, _edges)`` of polygon parts ``ring[, holes], xmin, ymin, xmax, ymax``."""
    shaped = dealt(polys).select(*keys, "xmin", "ymin", "xmax", "ymax", edges(_rings(polys)).alias("_edges"))
    return staged(_fitted(ranges(shaped), keys, convex), "cells")


def _levels(cells: DataFrame) -> list[int]:
    return sorted(r[0] for r in cells.select("_lv").distinct().collect())       # at most a dozen


def _placed(points: DataFrame, cells: DataFrame, keys: list[str], convex: bool = False,
            pad_y: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Points with the cell of the finest level in use, and the index on that level: what a larger cell carries is fitted to each
    of the occupied cells in it."""
    levels = _levels(cells)
    if not levels:
        return points.withColumns({"_gx": F.lit(None).cast("long"), "_gy": F.lit(None).cast("long")}), cells
    s = 2.0 ** levels[0]
    points = points.withColumns({"_gx": F.floor(F.col("x") / s), "_gy": F.floor(F.col("y") / s)})
    if len(levels) == 1:
        return points, cells
    occupied = points.select(F.col("_gx").alias("_fx"), F.col("_gy").alias("_fy")).distinct()
    asked = occupied.withColumn("_lv", F.explode(F.lit(levels)))
    up = F.pow(F.lit(2.0), (F.col("_lv") - levels[0]).cast("double"))
    found = asked.withColumns({"_gx": F.floor(F.col("_fx") / up), "_gy": F.floor(F.col("_fy") / up)}).join(cells, _KEY)
    found = found.drop("_gx", "_gy").withColumnsRenamed({"_fx": "_gx", "_fy": "_gy"}).withColumn("_lv", F.lit(levels[0]))
    fitted = narrowed(found.where("not _inner"), keys, convex, pad_y)
    return points, found.where("_inner").select(fitted.columns).unionByName(fitted).drop("_lv")


def _points(points: DataFrame, id_col: str, x: str, y: str) -> DataFrame:
    return points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(x).alias("x"), F.col(y).alias("y"))


def inside(points: DataFrame, polys: DataFrame, keys: list[str], convex: bool = False, *, id_col: str = "id", x: str = "lon",
           y: str = "lat") -> DataFrame:
    """``(id, x, y, keys..)`` for every point strictly inside a polygon part; a point row meets a part once."""
    placed, cells = _placed(_points(points, id_col, x, y), index(polys, keys, convex), keys, convex)
    px, py = F.col("x"), F.col("y")
    test = F.forall("_edges", lambda e: side(e, px, py) > 0) if convex else (
        odd(F.col("_edges"), px, py) & ~on_any(F.col("_edges"), px, py))
    return placed.join(cells, ["_gx", "_gy"]).where(F.col("_inner") | test).select("id", "x", "y", *keys)


# distance ------------------------------------------------------------------------------------------------------------

def near(points: DataFrame, polys: DataFrame, keys: list[str], metres: float, *, id_col: str = "id", x: str = "lon",
         y: str = "lat") -> DataFrame:
    """``(id, x, y, keys.., distance)`` for points within ``metres`` of a polygon part, 0 inside.

    Local plane at the point (within 1 m); the inside of a hole is outside. A cell carries the edges that reach it.
    """
    pad_x, pad_y = degree_pads(metres)
    shaped = dealt(polys).select(*keys, "xmin", "ymin", "xmax", "ymax", pad_x.alias("_px"), edges(_rings(polys)).alias("_edges"))
    spans = ranges(shaped, F.col("_px"), pad_y).withColumn("_near", F.col("_edges"))
    cells = staged(_fitted(spans, keys, pad_y=pad_y), "near-cells")
    placed, cells = _placed(_points(points, id_col, x, y), cells, keys, pad_y=pad_y)
    px, py = F.col("x"), F.col("y")
    within = odd(F.col("_edges"), px, py)
    gap = geo.distance_to_edges(F.col("_near"), px, py)
    return placed.join(cells, ["_gx", "_gy"]).withColumn("distance", F.when(F.col("_inner") | within, 0.0).otherwise(gap)).where(
        F.col("distance") <= metres).select("id", "x", "y", *keys, "distance")


def with_rows(points: DataFrame, found: DataFrame, id_col: str = "id", x: str = "lon", y: str = "lat") -> DataFrame:
    """Whole point rows for ``found(id, x, y, ..)``; matched by id and place, so repeated ids keep their own places."""
    if set(points.columns) <= {id_col, x, y}:
        return found.withColumnsRenamed({"id": id_col, "x": x, "y": y})
    once = found.dropDuplicates().withColumnsRenamed({"id": "_id", "x": "_x", "y": "_y"})
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col(x) == F.col("_x")) & (F.col(y) == F.col("_y"))
    return points.join(once, same).drop("_id", "_x", "_y")
