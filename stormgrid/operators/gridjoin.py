"""Spatial joins as equi-joins on grid cells with an exact test.

A bare spatial predicate would be planned as a cartesian product. Polygons are listed under the cells
their (padded) envelope covers, on a level whose cell side is at least a quarter of the envelope, so a
polygon covers at most 6 x 6 cells whatever its size. A point has one cell per level in use, so each
pair meets at most once and no distinct is needed afterwards.

Neither side is hinted: the planner broadcasts the polygon cells only when their measured size allows
it, otherwise both sides shuffle by cell and adaptive execution splits hot cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FINEST, _COARSEST, _STEP = -16, 8, 2     # cell side = 2**level degrees


def _level(extent: Column) -> Column:
    raw = F.ceil(F.log2(F.greatest(extent, F.lit(2.0 ** (_FINEST + 2))) / 4) / _STEP) * _STEP
    return F.least(F.greatest(raw, F.lit(_FINEST)), F.lit(_COARSEST)).cast("int")


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level.cast("double"))


def ranges(polys: DataFrame, pad_x=0.0, pad_y=0.0, box=("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """Adds ``_lv`` and the first and last cell in either direction: ``_gx0, _gx1, _gy0, _gy1``."""
    px, py = (p if isinstance(p, Column) else F.lit(float(p)) for p in (pad_x, pad_y))
    x0, y0, x1, y1 = (F.col(c) for c in box)
    df = polys.withColumns({"_x0": x0 - px, "_x1": x1 + px, "_y0": y0 - py, "_y1": y1 + py})
    df = df.withColumn("_lv", _level(F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))))
    s = _side(F.col("_lv"))
    return df.withColumns({f"_g{c}": F.floor(F.col(f"_{c}") / s) for c in ("x0", "x1", "y0", "y1")}).drop("_x0", "_x1", "_y0", "_y1")


def cover(polys: DataFrame, pad_x=0.0, pad_y=0.0, box=("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """One row per polygon and grid cell: adds ``_lv, _gx, _gy``."""
    return (ranges(polys, pad_x, pad_y, box).withColumn("_gx", F.explode(F.sequence("_gx0", "_gx1")))
            .withColumn("_gy", F.explode(F.sequence("_gy0", "_gy1"))).drop("_gx0", "_gx1", "_gy0", "_gy1"))


def levels_in_use(covered: DataFrame) -> list[int]:
    """At most (coarsest - finest) / step + 1 small integers."""
    return sorted(r[0] for r in covered.select("_lv").distinct().collect())


def locate(points: DataFrame, levels: list[int], x: str, y: str) -> DataFrame:
    df = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if len(levels) == 1:
        df = df.withColumn("_lv", F.lit(levels[0]))
    else:
        df = df.withColumn("_lv", F.explode(F.array(*[F.lit(v) for v in levels])) if levels
                           else F.lit(None).cast("int"))
    s = _side(F.col("_lv"))
    return df.withColumns({"_gx": F.floor(F.col(x) / s), "_gy": F.floor(F.col(y) / s)})


_KEY = ["_lv", "_gx", "_gy"]


def points_in_polygons(points: DataFrame, polys: DataFrame, test: Column, *, x: str = "lon", y: str = "lat",
                       pad_x=0.0, pad_y=0.0) -> DataFrame:
    """Inner join; ``test`` is the exact predicate over columns of both sides (no shared names)."""
    covered = cover(polys, pad_x, pad_y)
    placed = locate(points, levels_in_use(covered), x, y)
    return placed.join(covered, _KEY).where(test).drop(*_KEY)


def points_in_any(points: DataFrame, polys: DataFrame, test: Column, key: str, *, x: str = "lon",
                  y: str = "lat") -> DataFrame:
    """Points that satisfy ``test`` with some polygon, each once."""
    covered = cover(polys)
    levels = levels_in_use(covered)
    cells = covered.withColumnsRenamed({k: f"c{k}" for k in _KEY})
    placed = locate(points, levels, x, y)
    same = [F.col(k) == F.col(f"c{k}") for k in _KEY]
    found = placed.join(cells, [*same, test], "left_semi").drop(*_KEY)
    return found if len(levels) < 2 else found.dropDuplicates([key])


def degree_pads(metres: float, lat0: str = "ymin", lat1: str = "ymax") -> tuple[Column, float]:
    """Padding in degrees that surely covers ``metres`` around an envelope."""
    dlat = metres / 110_000.0
    lat = F.least(F.greatest(F.abs(F.col(lat0)), F.abs(F.col(lat1))) + dlat, F.lit(89.0))
    return F.lit(metres / 110_000.0) / F.cos(F.radians(lat)), dlat
