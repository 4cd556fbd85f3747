"""Building blocks of the DuckDB side: clustering, hull edges and distances in plain SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .inputs import ctes


def dbscan_sql(name: str, src: str, eps: float, m: int, by: str | None = None, rounds: int = 10) -> str:
    """CTEs ending in ``{name}(by, id, lon, lat, label)``: neighbour pairs, then min-label rounds over cores."""
    b = f"{by}, " if by else ""
    same = f" and a.{by} = b.{by}" if by else ""
    on = lambda x, y: f"{x}.id = {y}" if not by else f"{x}.id = {y} and {x}.{by} = p.{by}"
    n = name
    out = [
        f"{n}_g as materialized (select {b}id, lon, lat, cast(floor(lon / {eps}) as bigint) gx, "
        f"cast(floor(lat / {eps}) as bigint) gy from {src} where lon is not null and lat is not null)",
        f"{n}_p as materialized (select {'a.' + by + ', ' if by else ''}a.id as a, b.id as b from "
        f"(select g.*, gx + dx as tx, gy + dy as ty from {n}_g g, (select unnest([-1, 0, 1]) dx), "
        f"(select unnest([-1, 0, 1]) dy)) a join {n}_g b on b.gx = a.tx and b.gy = a.ty{same} "
        f"where (a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= {eps} * {eps})",
        f"{n}_c as materialized (select {b}a as id from {n}_p group by all having count(*) >= {m})",
        f"{n}_k as materialized (select p.* from {n}_p p join {n}_c x on {on('x', 'p.a')} join {n}_c y on {on('y', 'p.b')})",
        f"{n}_r0 as materialized (select {b}id, id as l from {n}_c)",
    ]
    for i in range(1, rounds + 1):
        out.append(f"{n}_r{i} as materialized (select {'p.' + by + ', ' if by else ''}p.a as id, min(r.l) as l "
                   f"from {n}_k p join {n}_r{i - 1} r on {on('r', 'p.b')} group by all)")
    part = f"partition by {by} " if by else ""
    out.append(f"{n}_d as materialized (select {b}id, cast(dense_rank() over ({part}order by l) - 1 as integer) as label from {n}_r{rounds})")
    out.append(f"{n}_b as materialized (select {'p.' + by + ', ' if by else ''}p.a as id, min(d.label) as label from {n}_p p "
               f"join {n}_d d on {on('d', 'p.b')} group by all)")
    joined = f"d.id = g.id{' and d.' + by + ' = g.' + by if by else ''}"
    bord = f"b.id = g.id{' and b.' + by + ' = g.' + by if by else ''}"
    out.append(f"{n} as materialized (select {'g.' + by + ', ' if by else ''}g.id, g.lon, g.lat, coalesce(d.label, b.label, -1) as label "
               f"from {n}_g g left join {n}_d d on {joined} left join {n}_b b on {bord})")
    return ",\n".join(out)


def hull_sql(name: str, src: str, keys: list[str], x: str = "lon", y: str = "lat") -> str:
    """CTEs ending in ``{name}(keys, ax, ay, bx, by)``: counter-clockwise hull edges per key.

    Works on whole micro-degrees: a point is a vertex when no half plane of directions is free of it; the
    next vertex is the farthest point in the first direction after the free angle.
    """
    k = ", ".join(keys)
    p_k = ", ".join(f"p.{c}" for c in keys)
    same = " and ".join(f"p.{c} = q.{c}" for c in keys)
    n = name
    return ",\n".join([
        f"{n}_u as materialized (select distinct {k}, {x} as x, {y} as y, cast(round({x} * 1e6) as bigint) ix, "
        f"cast(round({y} * 1e6) as bigint) iy from {src} where {x} is not null and {y} is not null)",
        f"{n}_a as materialized (select {p_k}, p.x, p.y, q.x as qx, q.y as qy, atan2(q.iy - p.iy, q.ix - p.ix) as ang, "
        f"(q.ix - p.ix) * (q.ix - p.ix) + (q.iy - p.iy) * (q.iy - p.iy) as far "
        f"from {n}_u p join {n}_u q on {same} and (p.ix <> q.ix or p.iy <> q.iy))",
        f"{n}_w as (select {k}, x, y, lead(ang) over w as nxt, first_value(ang) over w as fst, ang from {n}_a "
        f"window w as (partition by {k}, x, y order by ang rows between unbounded preceding and unbounded following))",
        f"{n}_v as (select {k}, x, y, coalesce(nxt, fst) as start from {n}_w "
        f"where coalesce(nxt - ang, fst + 2 * pi() - ang) > pi() + 1e-11)",
        f"{n} as materialized (select {k}, x as ax, y as ay, arg_max(qx, far) as bx, arg_max(qy, far) as by_ "
        f"from {n}_v join {n}_a using ({k}, x, y) where abs(ang - start) < 1e-11 group by {k}, x, y)",
    ])


def ring_sql(edges: str, keys: str) -> str:
    """``{edges}_ring(keys, ring)``: the hull's vertices as text, by x then y."""
    return (f"{edges}_ring as (select {keys}, string_agg(printf('%.6f %.6f', ax, ay), ',' order by ax, ay) as ring "
            f"from {edges} group by {keys})")


def ring_text(ring: Column) -> Column:
    """The same of a ring column."""
    return F.array_join(F.transform(F.array_sort(F.array_distinct(ring)), lambda p: F.format_string("%.6f %.6f", p["x"], p["y"])), ",")


# Hail clusters with default parameters, hull edges and envelope
HAIL = (ctes("fx_hail") + ",\n" + dbscan_sql("lab", "fx_hail", 0.03, 6))
HAIL_STATS = """stats as materialized (select l.label as cluster_id, count(*) as num_points, min(h.valid) as start_time,
 max(h.valid) as end_time, min(l.lon) as xmin, min(l.lat) as ymin, max(l.lon) as xmax, max(l.lat) as ymax
 from lab l join fx_hail h on h.id = l.id where l.label >= 0 group by l.label)"""
HAIL_HULL = ("hp as (select label as cluster_id, lon, lat from lab where label >= 0),\n"
             + hull_sql("edge", "hp", ["cluster_id"]))
STORMS = ",\n".join([HAIL, HAIL_STATS, HAIL_HULL])

# metres per degree at latitude {lat}, as SQL
KX = "(cos(radians({lat})) * 6378137.0 / sqrt(1 - 0.0066943799901413165 * sin(radians({lat})) * sin(radians({lat}))) * pi() / 180)"
KY = ("(6378137.0 * (1 - 0.0066943799901413165) / pow(1 - 0.0066943799901413165 * sin(radians({lat})) * sin(radians({lat})), 1.5)"
      " * pi() / 180)")


def near_sql(name: str, addr: str, metres: float) -> str:
    """CTEs ending in ``{name}(id, cluster_id, d)``: metres from address to hull, 0 inside, within ``metres``."""
    kx, ky = KX.format(lat="a.lat"), KY.format(lat="a.lat")
    return f"""{name}_s as (select a.id, e.cluster_id, (e.bx - e.ax) * (a.lat - e.ay) - (e.by_ - e.ay) * (a.lon - e.ax) as side,
  (e.bx - e.ax) * {kx} as ux, (e.by_ - e.ay) * {ky} as uy, (a.lon - e.ax) * {kx} as wx, (a.lat - e.ay) * {ky} as wy
  from {addr} a join stats s on a.lon between s.xmin - 0.05 and s.xmax + 0.05 and a.lat between s.ymin - 0.05 and s.ymax + 0.05
  join edge e on e.cluster_id = s.cluster_id),
{name}_t as (select *, greatest(0, least(1, (wx * ux + wy * uy) / (ux * ux + uy * uy))) as t from {name}_s),
{name} as materialized (select id, cluster_id, case when min(side) >= 0 then 0.0 else min(sqrt((wx - t * ux) * (wx - t * ux) + (wy - t * uy) * (wy - t * uy))) end as d
  from {name}_t group by id, cluster_id having d <= {metres})"""
