"""Distributed exact DBSCAN on planar coordinates.

Points fall into square cells whose diagonal is just under ``eps`` (Gan and Tao, 2015), so

* a cell with ``min_samples`` points is *dense*: all its points are core and in one cluster;
* a *thin* cell holds fewer than ``min_samples`` points, so its point list is short by construction.

A dense cell is never listed. It is summarised by the tight boxes of its 8 x 8 sub-cells, an aggregate
with map-side combine, so a cell (or one coordinate) holding a third of all points costs no more than
any other. Box distances settle nearly every question; what stays open is settled on points of the
boxes in question only, or by splitting those boxes again. No step lists pairs of points of a cell.

Neighbours include the point itself and points at exactly ``eps``. Clusters are numbered by their
smallest core id; a border point reachable from several clusters joins the lowest label.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from . import skew, tiles
from .components import connected_components
from .numbering import index_within

_BITS = 3           # 2**3 sub-cells per cell side
_SIDE = 0.7071      # cell side / eps, under 1/sqrt(2)


def dbscan(points: DataFrame, eps: float, min_samples: int, *, id_col: str = "id", x: str = "lon",
           y: str = "lat", by: list[str] | None = None, label: str = "label",
           hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Add ``label`` (-1 for noise) to ``points``; ids are unique within ``by``.

    With ``by`` every group is clustered on its own and labels start from 0 in each; null values are a group
    like any other. Points without a coordinate (null or NaN) are noise.
    """
    by = list(by or [])
    located = _locate(points, x, y, eps)
    if by:      # one key that is never null, so that plain equality joins groups
        located, by = located.withColumn("_by", _group(located, by)), ["_by"]
    table, hot_rows = _cell_labels(located.select(*by, F.col(id_col).alias("pid"), F.col(x).alias("px"),
                                        F.col(y).alias("py"), "_fx", "_fy", "_cx", "_cy")
                         .where("_cx is not null and _cy is not null"),
                         eps, min_samples, by, hot_rows)
    found = skew.lookup(located, table, [*by, "_cx", "_cy"], "n", ["_cell", "_each"], hot_rows)
    mine = F.filter("_each", lambda e: e["pid"] == F.col(id_col))
    return (found.withColumn(label, F.coalesce("_cell", F.get(mine, F.lit(0))["label"], F.lit(-1)))
            .drop("_fx", "_fy", "_cx", "_cy", "_cell", "_each", "_by"))


def _group(df: DataFrame, by: list[str]) -> Column:
    """Text of the group's values; a single int of 32 bits or fewer as a long, with a value of its own for null."""
    if len(by) == 1 and df.select(*by).schema[0].dataType.simpleString() in ("tinyint", "smallint", "int"):
        return F.coalesce(F.col(by[0]).cast("long"), F.lit(1 << 32))
    return F.to_json(F.struct(*by))


def _locate(df: DataFrame, x: str, y: str, eps: float) -> DataFrame:
    side = F.lit(_SIDE * eps / (1 << _BITS))
    known = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    df = df.withColumns({"_fx": F.floor(known(x) / side), "_fy": F.floor(known(y) / side)})
    return df.withColumns({"_cx": F.shiftright("_fx", _BITS), "_cy": F.shiftright("_fy", _BITS)})


# Distances as SQL text: ``a`` and ``b`` name boxes (x0, x1, y0, y1)

def _sum2(dx: str, dy: str) -> str:
    return f"({dx}) * ({dx}) + ({dy}) * ({dy})"


def _near2(a: str, b: str) -> str:
    """Squared distance of two boxes (0 where they overlap)."""
    return _sum2(*[f"greatest({a}.{v}0 - {b}.{v}1, {b}.{v}0 - {a}.{v}1, 0D)" for v in "xy"])


def _far2(a: str, b: str) -> str:
    """Squared distance of the farthest points of two boxes."""
    return _sum2(*[f"greatest(abs({a}.{v}1 - {b}.{v}0), abs({b}.{v}1 - {a}.{v}0))" for v in "xy"])


def _linked(a: str, b: str, e2: float) -> str:
    return f"exists({a}, a -> exists({b}, b -> {_far2('a', 'b')} <= {e2!r}D))"


def _boxes(pts: DataFrame, keys: list[str], fx: str, fy: str) -> DataFrame:
    return pts.groupBy(*keys, fx, fy).agg(
        F.count("*").alias("n"), F.min("pid").alias("lo"),
        F.min("px").alias("x0"), F.max("px").alias("x1"),
        F.min("py").alias("y0"), F.max("py").alias("y1"))


def _cell_labels(pts: DataFrame, eps: float, m: int, by: list[str], hot_rows: int) -> tuple[DataFrame, int | None]:
    """Per cell: size ``n``, ``_cell`` label of a dense cell or ``_each`` labels of a thin cell's points.

    Also the threshold to go on with: None once it is known that no cell is hot, which spares later
    joins their hot branch.
    """
    e2 = eps * eps
    cell = [*by, "_cx", "_cy"]
    cells = durable(
        _boxes(pts, cell, "_fx", "_fy").groupBy(*cell).agg(
            F.sum("n").alias("n"), F.min("lo").alias("node"),
            F.collect_list(F.struct("_fx", "_fy", "n", "x0", "x1", "y0", "y1")).alias("boxes")))
    dense, thin = cells.where(F.col("n") >= m), cells.where(F.col("n") < m)

    # thin cells with their points; points of hot cells never enter the shuffle
    hot = skew.hottest(cells, cell, "n", hot_rows).select(*cell)
    cool = pts.join(F.broadcast(hot), cell, "left_anti")
    if hot.isEmpty():
        cool, hot_rows = pts, None
    listed = durable(
        cool.join(thin.select(*cell), cell, "left_semi")
        .groupBy(*cell).agg(F.collect_list(F.struct("pid", "px", "py")).alias("pts")))

    # what tiles tell: neighbour counts of thin points, links of dense cells
    entries = dense.select(*cell, "node", "boxes").unionByName(listed, allowMissingColumns=True)
    told = durable(tiles.facts(tiles.tiled(entries, by, ["node", "boxes", "pts"]), by, tiles.cell_facts(e2, m)))
    kind = lambda k: told.where(F.col("kind") == k)
    more = _settle_counts(kind(tiles.MAYBE), pts, e2, m, by, hot_rows)

    # core test of thin points
    tally = (kind(tiles.HITS).selectExpr(*by, "a as pid", "b as hits", "cast(null as bigint) as near")
             .unionByName(kind(tiles.NEAR).selectExpr(*by, "a as pid", "0L as hits", "b as near"))
             .unionByName(more.selectExpr(*by, "pid", "hits", "tnode as near")))
    tally = tally.groupBy(*by, "pid").agg(F.sum("hits").alias("hits"), F.collect_set("near").alias("near"))
    flags = (listed.selectExpr(*cell, "inline(pts)").join(tally, [*by, "pid"])
             .selectExpr(*cell, "pid", "px", "py", f"hits >= {m} as core", "near"))
    known = durable(flags.groupBy(*cell).agg(
        F.expr("min(pid) filter (where core)").alias("node"),
        F.expr("collect_list(struct(pid, px, py, core, near))").alias("pts")))

    # what links cells
    wide = kind(tiles.LINK).selectExpr(*by, "a as na", "b as nb", "c = 1 as linked")
    slim = known.withColumn("pts", F.expr("transform(pts, p -> struct(p.pid, p.px, p.py, p.core))"))
    thin_told = durable(tiles.facts(tiles.tiled(slim, by, ["node", "pts"]), by, tiles.core_facts(e2)))
    each = known.selectExpr(*by, "node", "explode(pts) as p")
    edges = [wide.where("linked").selectExpr(*by, "na as a", "nb as b"),
             thin_told.where(F.col("kind") == tiles.EDGE).select(*by, "a", "b"),
             each.where("p.core").selectExpr(*by, "node as a", "explode(p.near) as b")]
    comp = connected_components(reduce(DataFrame.unionByName, edges), by)
    comp = _settle_links(wide.where("not linked"), dense, pts, comp, e2, by, hot_rows)

    nodes = dense.select(*by, "node").unionByName(known.where("node is not null").select(*by, "node"))
    rooted = nodes.join(comp, [*by, "node"], "left").selectExpr(*by, "node", "coalesce(root, node) as root")
    numbers = index_within(rooted.select(*by, "root").distinct(), by, ["root"], "label")
    named = rooted.join(numbers, [*by, "root"]).selectExpr(*by, "node", "cast(label as int) as label")

    # border points take the lowest label among the clusters they touch
    loose = each.where("not p.core")
    reach = [loose.selectExpr(*by, "p.pid as pid", "explode(p.near) as node"),
             thin_told.where(F.col("kind") == tiles.TOUCH).selectExpr(*by, "a as pid", "b as node")]
    border = (reduce(DataFrame.unionByName, reach).join(named, [*by, "node"])
              .groupBy(*by, "pid").agg(F.min("label").alias("border")))
    thin_labels = (known.selectExpr(*cell, "node", "inline(pts)").join(named, [*by, "node"], "left")
                   .join(border, [*by, "pid"], "left")
                   .selectExpr(*cell, "pid", "if(core, label, border) as label")
                   .groupBy(*cell).agg(F.count("*").alias("n"),
                                       F.expr("collect_list(struct(pid, label))").alias("_each")))
    dense_labels = dense.join(named, [*by, "node"]).selectExpr(*cell, "n", "label as _cell")
    return durable(thin_labels.unionByName(dense_labels, allowMissingColumns=True)), hot_rows


def _settle_counts(open_boxes: DataFrame, pts: DataFrame, e2: float, m: int, by: list[str],
                   hot_rows: int | None) -> DataFrame:
    """Neighbours of thin points in boxes that reach across eps, counted on the points of those boxes.

    A box is asked about by at most the thin points of the cells around its own.
    """
    asked = open_boxes.selectExpr(*by, "c as _fx", "d as _fy", "a as qid", "x as qx", "y as qy", "b as tnode", "e as bn")
    if asked.isEmpty():
        return asked.selectExpr(*by, "qid as pid", "tnode", "bn as hits")
    return (skew.expand(pts, asked, [*by, "_fx", "_fy"], "bn", (2 * tiles.RIM + 1) ** 2 * m, hot_rows)
            .where(f"{_sum2('px - qx', 'py - qy')} <= {e2!r}D")
            .groupBy(*by, F.col("qid").alias("pid"), "tnode").agg(F.count("*").alias("hits")))


def _settle_links(unsure: DataFrame, dense: DataFrame, pts: DataFrame, comp: DataFrame, e2: float,
                  by: list[str], hot_rows: int | None) -> DataFrame:
    """Decide open pairs that would join two components, by splitting their undecided boxes again.

    A box with one distinct coordinate decides exactly, so the loop ends; each round looks only at
    points in boxes of pairs that are still open.
    """
    if unsure.isEmpty():
        return comp

    def rooted(df: DataFrame, comp: DataFrame) -> DataFrame:
        for n, r in (("na", "ra"), ("nb", "rb")):
            c = comp.select(*by, F.col("node").alias(n), F.col("root").alias(r))
            df = df.join(c, [*by, n], "left").withColumn(r, F.coalesce(r, n))
        return df.where("ra <> rb")

    rest = rooted(unsure, comp)
    if rest.isEmpty():
        return comp
    rest = durable(rest)
    boxed = dense.select(*by, "node", "boxes")
    cut = (rest.join(boxed.select(*by, F.col("node").alias("na"), F.col("boxes").alias("ba")), [*by, "na"])
           .join(boxed.select(*by, F.col("node").alias("nb"), F.col("boxes").alias("bb")), [*by, "nb"]))
    work, extra, shift = pts, [], 0
    pairs = durable(_open_boxes(cut, e2, by))
    while not pairs.isEmpty():
        shift += _BITS
        scale = float(1 << _BITS)
        ends = (pairs.select(*by, F.col("ax").alias("_fx"), F.col("ay").alias("_fy"), F.col("an").alias("bn"))
                .unionByName(pairs.select(*by, F.col("bx").alias("_fx"), F.col("by_").alias("_fy"),
                                          F.col("bn").alias("bn")))
                .groupBy(*by, "_fx", "_fy").agg(F.max("bn").alias("bn")))
        work = skew.expand(work, ends, [*by, "_fx", "_fy"], "bn", 1, hot_rows).drop("bn")
        # split every box at its own middle lines: new keys nest in the old ones
        frames = work.groupBy(*by, "_fx", "_fy").agg(
            F.min("px").alias("lx"), F.max("px").alias("hx"), F.min("py").alias("ly"), F.max("py").alias("hy"),
            F.count("*").alias("bn"))
        work = skew.lookup(work, frames, [*by, "_fx", "_fy"], "bn", ["lx", "hx", "ly", "hy"], hot_rows)
        part = lambda v, lo, hi: F.when(F.col(hi) > F.col(lo), F.least(
            F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * scale), F.lit(int(scale) - 1))).otherwise(0)
        work = durable(work.withColumns({
            "_gx": F.col("_fx") * int(scale) + part("px", "lx", "hx"),
            "_gy": F.col("_fy") * int(scale) + part("py", "ly", "hy")}).drop("lx", "hx", "ly", "hy"))
        kids = (_boxes(work, [*by, "_fx", "_fy"], "_gx", "_gy")
                .groupBy(*by, "_fx", "_fy").agg(F.collect_list(F.struct(
                    F.col("_gx").alias("_fx"), F.col("_gy").alias("_fy"), "n", "x0", "x1", "y0", "y1")).alias("k")))
        cut = (pairs.join(kids.select(*by, F.col("_fx").alias("ax"), F.col("_fy").alias("ay"),
                                      F.col("k").alias("ba")), [*by, "ax", "ay"])
               .join(kids.select(*by, F.col("_fx").alias("bx"), F.col("_fy").alias("by_"),
                                 F.col("k").alias("bb")), [*by, "bx", "by_"]))
        cut = durable(cut.withColumn("linked", F.expr(_linked("ba", "bb", e2))))
        hit = cut.where("linked").select(*by, "na", "nb", "ra", "rb").distinct()
        extra.append(hit.select(*by, F.col("ra").alias("a"), F.col("rb").alias("b")))
        pairs = durable(_open_boxes(cut.join(hit.select(*by, "na", "nb"), [*by, "na", "nb"], "left_anti"), e2, by))
        work = work.drop("_fx", "_fy").withColumnsRenamed({"_gx": "_fx", "_gy": "_fy"})
    merged = connected_components(reduce(DataFrame.unionByName, extra), by)
    up = merged.select(*by, F.col("node").alias("root"), F.col("root").alias("top"))
    old = comp.join(up, [*by, "root"], "left").select(*by, "node", F.coalesce("top", "root").alias("root"))
    new = merged.join(comp.select(*by, "node"), [*by, "node"], "left_anti")
    return durable(old.unionByName(new.select(*by, "node", "root")))


def _open_boxes(cut: DataFrame, e2: float, by: list[str]) -> DataFrame:
    """Pairs of boxes whose distances do not decide yet; at most 64 x 64 per pair by construction."""
    pair = [*by, "na", "nb", "ra", "rb"]
    return (cut.selectExpr(*pair, "explode(ba) as a", "bb").selectExpr(*pair, "a", "explode(bb) as b")
            .where(f"{_near2('a', 'b')} <= {e2!r}D and {_far2('a', 'b')} > {e2!r}D")
            .selectExpr(*pair, "a._fx as ax", "a._fy as ay", "a.n as an", "b._fx as bx", "b._fy as by_", "b.n as bn"))
