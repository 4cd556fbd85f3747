"""Spatial address queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid.functions import geo, sql
from stormgrid.plans import addresses as plan
from stormgrid.session import staged
from stormgrid.sources.addresses import osm_addresses

from .hail import state_storms, storms
from .inputs import ctes, fx, table
from .leads import geodesic_sql
from .oracle_parts import KX, KY, STORMS, dbscan_sql, hull_sql, near_sql, ring_sql, ring_text

QUERIES, SQL = {}, {}
_LABELLED: dict = {}
CENTER, RADIUS_KM = (-88.3, 30.5), 110.0


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def labelled_addresses(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LABELLED:
        _LABELLED[key] = staged(plan.label_addresses(fx(spark, sf, "fx_addresses"), storms(spark, sf)), "labelled_addresses")
    return _LABELLED[key]


INSIDE = """inside as (select a.id, e.cluster_id from fx_addresses_edge a
 join stats s on a.lon between s.xmin and s.xmax and a.lat between s.ymin and s.ymax join edge e on e.cluster_id = s.cluster_id
 group by a.id, e.cluster_id having min((e.bx - e.ax) * (a.lat - e.ay) - (e.by_ - e.ay) * (a.lon - e.ax)) > 0)"""
# 32 vertices of the search area: metres in Web Mercator, back to degrees
AREA = f"""circ as (select k, degrees((radians({CENTER[0]}) * 6378137.0 + {RADIUS_KM * 1000} * cos(k * pi() / 16)) / 6378137.0) as x,
 degrees(2 * atan(exp((6378137.0 * ln(tan(radians({CENTER[1]}) / 2 + pi() / 4)) + {RADIUS_KM * 1000} * sin(k * pi() / 16)) / 6378137.0)) - pi() / 2) as y
 from (select unnest(range(0, 33)) as k)),
area as materialized (select a.x as ax, a.y as ay, b.x as bx, b.y as by_ from circ a join circ b on b.k = a.k + 1),
met as materialized (select cluster_id from edge e group by cluster_id having
 not exists (select 1 from area r where (select max((r.bx - r.ax) * (v.ay - r.ay) - (r.by_ - r.ay) * (v.ax - r.ax)) from edge v where v.cluster_id = e.cluster_id) < 0)
 and not exists (select 1 from edge g where g.cluster_id = e.cluster_id and (select max((g.bx - g.ax) * (r.ay - g.ay) - (g.by_ - g.ay) * (r.ax - g.ax)) from area r) < 0))"""


@query("addresses_in_storm", f"with {ctes('fx_addresses_edge')},\n{STORMS},\n{INSIDE} select id, cluster_id from inside")
def addresses_in_storm(spark, sf):
    return plan.in_storms(fx(spark, sf, "fx_addresses_edge"), storms(spark, sf)).select("id", "cluster_id")


@query("addresses_in_one_storm", f"with {ctes('fx_addresses_edge')},\n{STORMS},\n{INSIDE} select i.id, a.address from inside i join fx_addresses_edge a on a.id = i.id where cluster_id = 2")
def addresses_in_one_storm(spark, sf):
    return plan.in_storms(fx(spark, sf, "fx_addresses_edge"), storms(spark, sf), event=2).select("id", "address")


@query("addresses_in_any_storm", f"with {ctes('fx_addresses_edge')},\n{STORMS},\n{INSIDE} select distinct id from inside")
def addresses_in_any_storm(spark, sf):
    return plan.in_any_storm(fx(spark, sf, "fx_addresses_edge"), storms(spark, sf)).select("id")


@query("addresses_near_hail", f"with {ctes('fx_addresses_edge')},\n{STORMS},\n{near_sql('near', 'fx_addresses_edge', 200)} "
       "select id, cluster_id, round(d, 1) as distance_m from near")
def addresses_near_hail(spark, sf):
    near = plan.near_storms(fx(spark, sf, "fx_addresses_edge"), storms(spark, sf), 200.0)
    return near.select("id", "cluster_id", F.round("distance", 1).alias("distance_m"))


@query("hail_in_search_area", f"with {STORMS},\n{AREA} select s.cluster_id, s.num_points from stats s join met m on m.cluster_id = s.cluster_id")
def hail_in_search_area(spark, sf):
    return plan.storms_in_area(storms(spark, sf), CENTER, RADIUS_KM * 1000).select("cluster_id", "num_points")


@query("hail_in_envelope", f"""with {STORMS}, q as (select cluster_id from edge group by cluster_id having
 not exists (select 1 from edge g where g.cluster_id = edge.cluster_id and (select max((g.bx - g.ax) * (c.y - g.ay) - (g.by_ - g.ay) * (c.x - g.ax))
  from (values (-89.44, 30.48), (-88.66, 30.48), (-88.66, 30.86), (-89.44, 30.86)) c(x, y)) < 0))
select s.cluster_id, s.num_points from stats s join q on q.cluster_id = s.cluster_id where xmin <= -88.66 and xmax >= -89.44 and ymin <= 30.86 and ymax >= 30.48""")
def hail_in_envelope(spark, sf):
    return plan.storms_in_box(storms(spark, sf), "-89.44,30.48,-88.66,30.86").select("cluster_id", "num_points")


@query("osm_addresses_in_storm", f"""with {ctes('fx_addresses_edge')},
{STORMS},
{INSIDE} select a.id, a.number || ' ' || a.street || ', ' || a.city || ', ' || a.state || ' ' || a.zip as address
from fx_addresses_edge a where a.id in (select id from inside) and a.id % 7 <> 0""")
def osm_addresses_in_storm(spark, sf):
    tag = lambda k, c: [F.lit(f"addr:{k}"), F.col(c)]
    rest = F.create_map(*tag("street", "street"), *tag("city", "city"), *tag("state", "state"), *tag("postcode", "zip"))
    tags = F.when(F.col("id") % 7 == 0, rest).otherwise(F.map_concat(rest, F.create_map(*tag("housenumber", "number"))))
    nodes = fx(spark, sf, "fx_addresses_edge").select("id", "lat", "lon", tags.alias("tags"))
    return osm_addresses(plan.in_any_storm(nodes, storms(spark, sf))).select("id", "address")


@query("skiptrace_targets", f"""with {ctes('fx_addresses_edge')},
{STORMS},
{AREA},
okaddr as (select * from fx_addresses_edge a where state = 'IN' and address is not null and not regexp_matches(address, '(?i)PO\\s*BOX')
 and not regexp_matches(address, '(?i)(APT|UNIT|STE|SUITE|#\\s*[0-9]+)')
 and not exists (select 1 from area r where (r.bx - r.ax) * (a.lat - r.ay) - (r.by_ - r.ay) * (a.lon - r.ax) < 0)),
one as materialized (select * from okaddr qualify row_number() over (partition by lower(coalesce(address, '')), coalesce(zip, '') order by id) = 1),
{near_sql('near', 'one', 200)}
select o.id, o.address, o.street, o.city, o.state, o.zip, o.lon, o.lat, n.cluster_id, coalesce(s.end_time, s.start_time) as storm_time,
 cast(round(cast(n.d as decimal(18,6)), 1) as decimal(18,1)) as distance_m
from near n join met m on m.cluster_id = n.cluster_id join stats s on s.cluster_id = n.cluster_id join one o on o.id = n.id
order by storm_time desc nulls last, distance_m, o.id, n.cluster_id limit 1000""")
def skiptrace_targets(spark, sf):
    out = plan.skiptrace_targets(fx(spark, sf, "fx_addresses_edge"), storms(spark, sf), "IN", CENTER, RADIUS_KM, 200.0, 1000)
    return out.withColumn("distance_m", F.col("distance_m").cast("decimal(18,1)"))


CENTROIDS = """mid as materialized (select e.cluster_id as hail_cluster_id,
 any_value(xmin) + sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ax + bx - 2 * xmin))
  / (3 * sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin))) as cx,
 any_value(ymin) + sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ay + by_ - 2 * ymin))
  / (3 * sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin))) as cy
 from edge e join stats s on s.cluster_id = e.cluster_id group by e.cluster_id),
rad as (select k, cos(k * pi() / 32) as ux, sin(k * pi() / 32) as uy, cos((k + 1) * pi() / 32) as vx, sin((k + 1) * pi() / 32) as vy
 from (select unnest(range(0, 64)) as k)),
around as materialized (select hail_cluster_id, a.id, any_value(a.lon) as lon, any_value(a.lat) as lat from mid m
 join fx_addresses a on a.lon between cx - 0.01 and cx + 0.01 and a.lat between cy - 0.01 and cy + 0.01, rad
 group by hail_cluster_id, a.id
 having min(0.01 * (vx - ux) * (a.lat - cy - 0.01 * uy) - 0.01 * (vy - uy) * (a.lon - cx - 0.01 * ux)) >= 0)"""


@query("addresses_by_centroid_buffer", f"with {ctes('fx_addresses')},\n{STORMS},\n{CENTROIDS} select hail_cluster_id, id from around")
def addresses_by_centroid_buffer(spark, sf):
    near = plan.around_centroids(fx(spark, sf, "fx_addresses"), storms(spark, sf), 0.01)
    return near.select("hail_cluster_id", "id")


@query("address_clusters", f"""with {ctes('fx_addresses')},
{STORMS},
{CENTROIDS},
{dbscan_sql('al', 'around', 0.0006, 8, by='hail_cluster_id')},
ac as (select hail_cluster_id, label as addr_cluster_id, lon, lat from al where label >= 0),
{hull_sql('ah', 'ac', ['hail_cluster_id', 'addr_cluster_id'])},
{ring_sql('ah', 'hail_cluster_id, addr_cluster_id')}
select a.hail_cluster_id, a.addr_cluster_id, count(*) as num_addresses, min(lon) as xmin, min(lat) as ymin, max(lon) as xmax, max(lat) as ymax,
 coalesce(any_value(ring), printf('%.6f %.6f', min(lon), min(lat))) as ring
from ac a left join ah_ring r on r.hail_cluster_id = a.hail_cluster_id and r.addr_cluster_id = a.addr_cluster_id group by all""")
def address_clusters(spark, sf):
    return plan.address_clusters(labelled_addresses(spark, sf)).select(
        "hail_cluster_id", "addr_cluster_id", "num_addresses", "xmin", "ymin", "xmax", "ymax", ring_text(F.col("ring")).alias("ring"))


@query("address_noise_per_storm", f"""with {ctes('fx_addresses')},
{STORMS},
{CENTROIDS},
{dbscan_sql('al', 'around', 0.0006, 8, by='hail_cluster_id')}
select hail_cluster_id, count(*) as num_addresses, count(*) filter (label < 0) as num_noise from al group by hail_cluster_id""")
def address_noise_per_storm(spark, sf):
    return (labelled_addresses(spark, sf).groupBy("hail_cluster_id")
            .agg(F.count("*").alias("num_addresses"), F.count_if(F.col("addr_cluster_id") < 0).alias("num_noise")))


@query("untraced_addresses", f"with {ctes('fx_addresses', 'fx_traces')} select id, address from fx_addresses a "
       "where not exists (select 1 from fx_traces t where t.address_id = a.id) order by id limit 100")
def untraced_addresses(spark, sf):
    return plan.untraced(fx(spark, sf, "fx_addresses"), fx(spark, sf, "fx_traces"), 100)


@query("dedup_addresses", f"""with {ctes('fx_addresses')}
select * from fx_addresses where address is not null and not regexp_matches(address, '(?i)PO\\s*BOX')
 and not regexp_matches(address, '(?i)(APT|UNIT|STE|SUITE|#\\s*[0-9]+)')
 qualify row_number() over (partition by lower(coalesce(address, '')), coalesce(zip, '') order by id) = 1""")
def dedup_addresses(spark, sf):
    return plan.distinct_addresses(plan.deliverable(fx(spark, sf, "fx_addresses")))


@query("addresses_in_mercator", f"""with {ctes('fx_addresses')} select id, round(lon, 6) as lon, round(lat, 6) as lat, round(radians(lon) * 6378137.0, 1) as mx,
 round(6378137.0 * ln(tan(radians(lat) / 2 + pi() / 4)), 1) as my from fx_addresses""")
def addresses_in_mercator(spark, sf):
    mx, my = geo.to_mercator("lon", "lat")
    lon, lat = geo.from_mercator(mx, my)
    return fx(spark, sf, "fx_addresses").select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"),
                                                F.round(mx, 1).alias("mx"), F.round(my, 1).alias("my"))


# Storms in two parts around every block of addresses, in half micro-degrees from its centre: a U with a hole in its left arm, and a V.
U = [(-20000, -20000), (20000, -20000), (20000, 20000), (8000, 20000), (8000, -4000), (-8000, -4000), (-8000, 20000), (-20000, 20000)]
HOLE = [(-12600, -600), (-12600, 600), (-11400, 600), (-11400, -600)]
V = [(-1, 12000), (2999, 15000), (1999, 15000), (-1, 13000), (-2001, 15000), (-3001, 15000)]
_MID = "2 * (-89500000 + (c_custkey % 20) * 400000) as mx, 2 * (30500000 + cast(floor(c_custkey / 20) as bigint) * 350000) as my"


def _part_sql():
    pairs = [(part, *a, *b) for part, ring in ((0, U), (0, HOLE), (1, V)) for a, b in zip(ring, ring[1:] + ring[:1])]
    return ", ".join(f"({part}, {ax}, {ay}, {bx}, {by})" for part, ax, ay, bx, by in pairs)


PARTS = f"""{ctes('fx_addresses')},
mids as (select c_custkey as storm_id, {_MID} from customer),
sides(part, ax, ay, bx, by_) as (values {_part_sql()}),
partedge as (select storm_id, part, mx + ax as ax, my + ay as ay, mx + bx as bx, my + by_ as by_ from mids, sides),
pts as (select id, lon, lat, 2 * cast(round(lon * 1e6) as bigint) as px, 2 * cast(round(lat * 1e6) as bigint) as py from fx_addresses
 where lon is not null and lat is not null),
parthit as materialized (select p.id, storm_id, part,
 sum(case when (ay > py) <> (by_ > py) and (case when by_ > ay then (px - ax) * (by_ - ay) < (bx - ax) * (py - ay) else (px - ax) * (by_ - ay) > (bx - ax) * (py - ay) end) then 1 else 0 end) % 2 = 1 as odd,
 bool_or((bx - ax) * (py - ay) = (by_ - ay) * (px - ax) and px between least(ax, bx) and greatest(ax, bx) and py between least(ay, by_) and greatest(ay, by_)) as edge
 from pts p join mids m on px between mx - 24000 and mx + 24000 and py between my - 24000 and my + 24000 join partedge using (storm_id) group by all)"""


def parted_storms(spark, sf):
    """The storms above as one row per part, rings in degrees."""
    def ring(pts):
        return F.array(*[geo.vertex((F.col("mx") + x) / 2e6, (F.col("my") + y) / 2e6) for x, y in [*pts, pts[0]]])

    mids = table(spark, sf, "customer").selectExpr("c_custkey as storm_id", *_MID.split(", "))
    none = F.slice(F.array(ring(HOLE)), 1, 0)
    parts = F.array(F.struct(F.lit(0).alias("part"), ring(U).alias("ring"), F.array(ring(HOLE)).alias("holes")),
                    F.struct(F.lit(1).alias("part"), ring(V).alias("ring"), none.alias("holes")))
    return mids.select("storm_id", F.inline(parts)).withColumns(geo.bounds(F.col("ring")))


@query("addresses_in_multipolygon", f"with {PARTS} select id, storm_id, part from parthit where odd and not edge")
def addresses_in_multipolygon(spark, sf):
    return plan.in_storms(fx(spark, sf, "fx_addresses"), parted_storms(spark, sf), ("storm_id", "part"), convex=False).select(
        "id", "storm_id", "part")


@query("addresses_in_any_part", f"with {PARTS} select id, address from fx_addresses where id in (select id from parthit where odd and not edge)")
def addresses_in_any_part(spark, sf):
    return plan.in_any_storm(fx(spark, sf, "fx_addresses"), parted_storms(spark, sf), convex=False).select("id", "address")


_NEAR = f"""with {PARTS},
legs as (select p.id, storm_id, part, (bx - ax) / 2e6 * {KX.format(lat='lat')} as ux, (by_ - ay) / 2e6 * {KY.format(lat='lat')} as uy,
 (lon - ax / 2e6) * {KX.format(lat='lat')} as wx, (lat - ay / 2e6) * {KY.format(lat='lat')} as wy
 from pts p join mids m on px between mx - 24000 and mx + 24000 and py between my - 24000 and my + 24000 join partedge using (storm_id)),
spot as (select *, greatest(0, least(1, (wx * ux + wy * uy) / (ux * ux + uy * uy))) as t from legs),
gap as (select id, storm_id, part, min(sqrt((wx - t * ux) * (wx - t * ux) + (wy - t * uy) * (wy - t * uy))) as d from spot group by all)
select id, storm_id, part, round(case when odd and not edge then 0.0 else d end, 1) as distance_m from gap join parthit using (id, storm_id, part)
where case when odd and not edge then 0.0 else d end <= 60"""


@query("addresses_near_parts", _NEAR)
def addresses_near_parts(spark, sf):
    near = plan.near_storms(fx(spark, sf, "fx_addresses"), parted_storms(spark, sf), 60.0, ("storm_id", "part"))
    return near.select("id", "storm_id", "part", F.round("distance", 1).alias("distance_m"))


@query("storms_in_area_parts", f"""with {PARTS},
{AREA.split(',' + chr(10) + 'met as')[0]},
line as (select storm_id, part, ax / 2e6 as ax, ay / 2e6 as ay, bx / 2e6 as bx, by_ / 2e6 as by_ from partedge),
cross_ as (select storm_id, part from line e, area r where
 ((e.bx - e.ax) * (r.ay - e.ay) - (e.by_ - e.ay) * (r.ax - e.ax) > 0) <> ((e.bx - e.ax) * (r.by_ - e.ay) - (e.by_ - e.ay) * (r.bx - e.ax) > 0) and
 ((r.bx - r.ax) * (e.ay - r.ay) - (r.by_ - r.ay) * (e.ax - r.ax) > 0) <> ((r.bx - r.ax) * (e.by_ - r.ay) - (r.by_ - r.ay) * (e.bx - r.ax) > 0)),
held as (select storm_id, part from line e where (select min((r.bx - r.ax) * (e.ay - r.ay) - (r.by_ - r.ay) * (e.ax - r.ax)) from area r) >= 0)
select distinct storm_id, part from (select * from cross_ union all select * from held)""")
def storms_in_area_parts(spark, sf):
    return plan.storms_in_area(parted_storms(spark, sf), CENTER, RADIUS_KM * 1000, convex=False).select("storm_id", "part")


@query("sql_grid_join", f"with {ctes('fx_addresses_edge')},\n{STORMS},\n{INSIDE} select id, cluster_id from inside")
def sql_grid_join(spark, sf):
    """The join of addresses_in_storm written in SQL: cells of the storms by a table function, the exact test on what meets."""
    sql.register(spark)
    storms(spark, sf).createOrReplaceTempView("grid_storms")
    fx(spark, sf, "fx_addresses_edge").createOrReplaceTempView("grid_addresses")
    return spark.sql("""
        WITH covered AS (SELECT s.cluster_id, s.ring, c.gx, c.gy FROM grid_storms s, LATERAL sg_cells(s.xmin, s.ymin, s.xmax, s.ymax, 0.125D) c),
        placed AS (SELECT id, lon, lat, floor(lon / 0.125D) AS gx, floor(lat / 0.125D) AS gy FROM grid_addresses)
        SELECT p.id, c.cluster_id FROM placed p JOIN covered c ON p.gx = c.gx AND p.gy = c.gy WHERE sg_contains(c.ring, p.lon, p.lat)""")


@query("sql_metres", f"""with {ctes('fx_addresses')}, located as (select id, lon, lat from fx_addresses where lon is not null and lat is not null),
{geodesic_sql(-88.9, 30.5)} select id, round(d, 1) as metres, round(lon, 6) as lon, round(lat, 6) as lat from dist where d <= 40000""")
def sql_metres(spark, sf):
    sql.register(spark)
    fx(spark, sf, "fx_addresses").createOrReplaceTempView("metre_addresses")
    return spark.sql("""SELECT id, round(sg_metres(lon, lat, -88.9D, 30.5D), 1) AS metres, round(sg_lon(sg_mercator_x(lon)), 6) AS lon,
        round(sg_lat(sg_mercator_y(lat)), 6) AS lat FROM metre_addresses WHERE sg_metres(lon, lat, -88.9D, 30.5D) <= 40000""")


_BY_STATE = f"""{ctes('fx_hail')},
{dbscan_sql('lab', 'fx_hail', 0.03, 6, by='state')},
stats as materialized (select l.state, l.label as cluster_id, max(h.valid) as end_time, min(l.lon) as xmin, min(l.lat) as ymin,
 max(l.lon) as xmax, max(l.lat) as ymax from lab l join fx_hail h on h.id = l.id where l.label >= 0 group by l.state, l.label),
hp as (select state, label as cluster_id, lon, lat from lab where label >= 0),
{hull_sql('edge', 'hp', ['state', 'cluster_id'])}"""


@query("addresses_in_storm_by_state", f"""with {_BY_STATE.replace('fx_hail as', ctes('fx_addresses_edge') + ', fx_hail as', 1)}
select a.id, e.state as storm_state, e.cluster_id from fx_addresses_edge a
 join stats s on a.lon between s.xmin and s.xmax and a.lat between s.ymin and s.ymax join edge e on e.cluster_id = s.cluster_id and e.state = s.state
 group by a.id, e.state, e.cluster_id having min((e.bx - e.ax) * (a.lat - e.ay) - (e.by_ - e.ay) * (a.lon - e.ax)) > 0""")
def addresses_in_storm_by_state(spark, sf):
    """Storms numbered per state: the same number names several, so the state is part of the key."""
    by_state = state_storms(spark, sf).withColumnRenamed("state", "storm_state")
    return plan.in_storms(fx(spark, sf, "fx_addresses_edge"), by_state, ("storm_state", "cluster_id")).select(
        "id", "storm_state", "cluster_id")
