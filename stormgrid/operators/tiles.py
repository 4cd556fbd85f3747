"""Neighbourhood tests between grid cells, one tile of cells at a time.

Looking at 24 neighbouring cells by a join would copy every cell 24 times through the shuffle. A tile of
16 x 16 cells plus a rim of two needs 1.6 copies, and its size is bounded by construction: at most 20 x 20
cells, each with at most 64 boxes (dense cell) or fewer than ``min_samples`` points (thin cell). The
tests inside a tile are small numpy helpers; Spark partitions and moves the tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RIM = 2             # cells within eps lie at most this many cells away
_BITS = 4           # 2**4 cells per tile side
_MOST = 1 << 18     # pairs of boxes compared at once
_HALF = [(dx, dy) for dx in range(-RIM, RIM + 1) for dy in range(-RIM, RIM + 1) if (dx, dy) > (0, 0)]

FACT = "kind int, a long, b long, c long, d long, e long, x double, y double"
HITS, NEAR, MAYBE, LINK = 0, 1, 2, 3     # kinds of facts about cells
EDGE, TOUCH = 0, 1                       # kinds of facts about thin points with known cores


def tiled(cells: DataFrame, by: list[str], entry: list[str]) -> DataFrame:
    """One row per tile with its cells and rim: ``cells array<struct<_cx, _cy, home, entry..>>``."""
    span = lambda c: f"explode(sequence(shiftright({c} - {RIM}, {_BITS}), shiftright({c} + {RIM}, {_BITS})))"
    copies = (cells.selectExpr("*", f"{span('_cx')} as _tx").selectExpr("*", f"{span('_cy')} as _ty")
              .withColumn("home", F.expr(f"_tx = shiftright(_cx, {_BITS}) and _ty = shiftright(_cy, {_BITS})")))
    return (copies.groupBy(*by, "_tx", "_ty").agg(F.collect_list(F.struct("_cx", "_cy", "home", *entry)).alias("cells"))
            .where("exists(cells, c -> c.home)"))


def facts(tiles: DataFrame, by: list[str], find) -> DataFrame:
    """Run ``find(tile) -> list of fact arrays`` on every tile; rows of FACT with the ``by`` columns."""
    spark = tiles.sparkSession
    schema = spark.createDataFrame([], ", ".join(
        [f"{c} {tiles.schema[c].dataType.simpleString()}" for c in by] + [FACT])).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for i, tile in enumerate(_unpack(batch.column("cells"))):
                got = find(tile)
                found += got
                rows += [np.full(len(f["kind"]), i) for f in got]
            if not found:
                continue
            at = pa.array(np.concatenate(rows))
            cols = [batch.column(c).take(at) for c in by]
            for c in names[len(by):]:
                kind = np.int32 if c == "kind" else np.float64 if c in "xy" else np.int64
                cols.append(pa.array(np.concatenate([f.get(c, np.zeros(len(f["kind"]))).astype(kind) for f in found])))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return tiles.mapInArrow(run, schema)


def _unpack(lists: pa.ListArray) -> Iterator[dict]:
    """Tiles of a batch as numpy columns; nested lists get the index of their cell."""
    cells = lists.flatten()
    ends = np.cumsum(lists.value_lengths().to_numpy())
    cols, inner = {}, {}
    for f in cells.type:
        v = cells.field(f.name)
        if pa.types.is_list(f.type):
            stops = np.concatenate([[0], np.cumsum(v.value_lengths().fill_null(0).to_numpy())])
            flat = v.flatten()
            inner[f.name] = (stops, {g.name: _numpy(flat.field(g.name)) for g in flat.type})
        else:
            cols[f.name] = _numpy(v)
    for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends):
        tile = {k: v[lo:hi] for k, v in cols.items()}
        for k, (stops, sub) in inner.items():
            part = {g: v[stops[lo]:stops[hi]] for g, v in sub.items()}
            part["cell"] = np.repeat(np.arange(hi - lo), np.diff(stops[lo:hi + 1]))
            tile[k] = part
        yield tile


def _numpy(v: pa.Array) -> np.ndarray:
    return v.fill_null(0).to_numpy(zero_copy_only=False) if v.null_count else v.to_numpy(zero_copy_only=False)


def _chunks(n: int, width: int) -> Iterator[slice]:
    step = max(1, 2_000_000 // max(width, 1))
    return (slice(s, min(s + step, n)) for s in range(0, n, step))


def _gap(a0, a1, b0, b1):
    return np.maximum(np.maximum(a0 - b1, b0 - a1), 0.0)


def _span(a0, a1, b0, b1):
    return np.maximum(np.abs(a1 - b0), np.abs(b1 - a0))


def cell_facts(e2: float, m: int):
    """HITS (point, neighbours known for sure), NEAR (point, dense cell), MAYBE (point, dense cell, open box,
    its size, point place) for thin points; LINK (dense cell, dense cell, 1 linked / 0 open), the linked
    ones as a star per connected part of the tile."""

    def find(t: dict) -> list[dict]:
        pts, box, out = t["pts"], t["boxes"], []
        mine = np.flatnonzero(t["home"][pts["cell"]])
        bx = [box[k] for k in ("x0", "x1", "y0", "y1")]
        for s in _chunks(len(mine), len(pts["px"]) + len(bx[0])):
            i = mine[s]
            px, py = pts["px"][i, None], pts["py"][i, None]
            dx, dy = px - pts["px"], py - pts["py"]
            hits = (dx * dx + dy * dy <= e2).sum(1)
            if len(bx[0]):
                gx, gy = _gap(px, px, bx[0], bx[1]), _gap(py, py, bx[2], bx[3])
                p, b = np.nonzero(gx * gx + gy * gy <= e2)
                fx, fy = _span(px[p, 0], px[p, 0], bx[0][b], bx[1][b]), _span(py[p, 0], py[p, 0], bx[2][b], bx[3][b])
                whole = fx * fx + fy * fy <= e2
                pair, at = np.unique(p * len(t["node"]) + box["cell"][b], return_inverse=True)
                sure = np.bincount(at, weights=box["n"][b] * whole, minlength=len(pair)).astype(np.int64)
                owner, cell = pair // len(t["node"]), pair % len(t["node"])
                hits = hits + np.bincount(owner, weights=sure, minlength=len(i)).astype(np.int64)
                k = sure > 0
                out.append({"kind": np.full(k.sum(), NEAR), "a": pts["pid"][i[owner[k]]], "b": t["node"][cell[k]]})
                k = ~whole & (sure[at] < m)
                out.append({"kind": np.full(k.sum(), MAYBE), "a": pts["pid"][i[p[k]]], "b": t["node"][cell[at[k]]],
                            "c": box["_fx"][b[k]], "d": box["_fy"][b[k]], "e": box["n"][b[k]],
                            "x": px[p[k], 0], "y": py[p[k], 0]})
            out.append({"kind": np.full(len(i), HITS), "a": pts["pid"][i], "b": hits})
        out += _links(t, bx, e2)
        return [f for f in out if len(f["kind"])]

    return find


def _links(t: dict, bx: list, e2: float) -> list[dict]:
    """Neighbouring dense cells, nearest first and all pairs of one offset at once; what is connected already is not asked again."""
    cell = t["boxes"]["cell"]
    cut = np.searchsorted(cell, np.arange(len(t["node"]) + 1))
    dense = np.flatnonzero(np.diff(cut))
    if not len(dense):
        return []
    first, size = cut[dense], np.diff(cut)[dense]
    gx, gy = (t[c][dense] - t[c][dense].min() + RIM for c in ("_cx", "_cy"))
    grid = np.full((gx.max() + RIM + 1, gy.max() + RIM + 1), -1)
    grid[gx, gy] = np.arange(len(dense))
    home, part = np.flatnonzero(t["home"][dense]), np.arange(len(dense))
    asked = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
    for dx, dy in sorted(_HALF, key=lambda d: d[0] * d[0] + d[1] * d[1]):
        i, j = home, grid[gx[home] + dx, gy[home] + dy]
        k = np.flatnonzero((j >= 0) & (part[i] != part[j]))
        i, j = i[k], j[k]
        if not len(i):
            continue
        near, linked = _box_tests(bx, first, size, i, j, e2)
        i, j, linked = i[near], j[near], linked[near]
        asked.append((i, j, linked))
        if linked.any():
            member, root = _stars(part[i[linked]], part[j[linked]])
            to = np.arange(len(dense))
            to[member] = root
            part = to[part]
    i, j, linked = (np.concatenate(x) for x in zip(*asked))
    na, nb = t["node"][dense[i]].astype(np.int64), t["node"][dense[j]].astype(np.int64)
    member, root = _stars(na[linked], nb[linked])
    # an open pair matters only between cells the tile does not connect already
    of = dict(zip(member.tolist(), root.tolist()))
    loose = ~linked & np.array([of.get(a, a) != of.get(b, b) for a, b in zip(na.tolist(), nb.tolist())], dtype=bool)
    far = member != root
    return [{"kind": np.full(far.sum(), LINK), "a": member[far], "b": root[far], "c": np.ones(far.sum())},
            {"kind": np.full(loose.sum(), LINK), "a": na[loose], "b": nb[loose]}]


def _box_tests(bx: list, first: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, e2: float) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of cells: some boxes come within eps, some lie within eps as a whole. ``_MOST`` pairs of boxes at a time."""
    near, linked = np.zeros(len(i), bool), np.zeros(len(i), bool)
    load = np.cumsum(size[i] * size[j])
    cuts = np.searchsorted(load, np.arange(_MOST, load[-1], _MOST)).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(i)]):
        if lo == hi:
            continue
        wide, n = size[j[lo:hi]], size[i[lo:hi]] * size[j[lo:hi]]
        start = np.cumsum(n) - n
        k = np.arange(n.sum()) - np.repeat(start, n)
        wide = np.repeat(wide, n)
        p, q = np.repeat(first[i[lo:hi]], n) + k // wide, np.repeat(first[j[lo:hi]], n) + k % wide
        a, b = [v[p] for v in bx], [v[q] for v in bx]
        x, y = _gap(a[0], a[1], b[0], b[1]), _gap(a[2], a[3], b[2], b[3])
        near[lo:hi] = np.minimum.reduceat(x * x + y * y, start) <= e2
        x, y = _span(a[0], a[1], b[0], b[1]), _span(a[2], a[3], b[2], b[3])
        linked[lo:hi] = np.minimum.reduceat(x * x + y * y, start) <= e2
    return near, linked


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a small graph with the smallest node they are connected to."""
    if not len(a):
        return a, a
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return nodes, nodes[low]
        low = new


def core_facts(e2: float):
    """EDGE (cell, cell) between thin cells with core points within eps, a star per connected part of the
    tile; TOUCH (border point, cell)."""

    def find(t: dict) -> list[dict]:
        pts, out = t["pts"], []
        core = np.flatnonzero(pts["core"])
        mine = np.flatnonzero(t["home"][pts["cell"]])
        if not len(core) or not len(mine):
            return out
        ab, node, width = [], t["node"], len(t["node"])
        qx, qy, qc = pts["px"][core], pts["py"][core], pts["cell"][core]
        for s in _chunks(len(mine), len(core)):
            i = mine[s]
            dx, dy = pts["px"][i, None] - qx, pts["py"][i, None] - qy
            p, q = np.nonzero(dx * dx + dy * dy <= e2)
            pair = np.unique(p * width + qc[q])
            p, c = i[pair // width], pair % width
            k = pts["core"][p].astype(bool)
            out.append({"kind": np.full((~k).sum(), TOUCH), "a": pts["pid"][p[~k]], "b": node[c[~k]]})
            ab.append(np.unique(pts["cell"][p[k]] * width + c[k]))
        ab = np.unique(np.concatenate(ab))
        a, b = node[ab // width], node[ab % width]
        member, root = _stars(a[a != b], b[a != b])
        far = member != root
        out.append({"kind": np.full(far.sum(), EDGE), "a": member[far], "b": root[far]})
        return [f for f in out if len(f["kind"])]

    return find
