"""Queries over hail points and storm events, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid.functions import geo, sql
from stormgrid.operators.hull import convex_hulls, solid
from stormgrid.plans import hail
from stormgrid.session import staged

from .inputs import ctes, fx
from .oracle_parts import HAIL, HAIL_STATS, STORMS, dbscan_sql, hull_sql, ring_sql, ring_text

QUERIES, SQL = {}, {}
_STORMS: dict = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def storms(spark, sf):
    """The stored cluster table the later steps read: built once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORMS:
        _STORMS[key] = staged(hail.hail_boundaries(fx(spark, sf, "fx_hail")), "hail_boundaries")
    return _STORMS[key]


def state_storms(spark, sf):
    """The same with storms numbered per state."""
    key = (spark.sparkContext.applicationId, sf, "state")
    if key not in _STORMS:
        _STORMS[key] = staged(hail.hail_boundaries(fx(spark, sf, "fx_hail"), by=["state"]), "hail_boundaries_by_state")
    return _STORMS[key]


@query("hail_clusters", f"with {HAIL},\n{HAIL_STATS} select * from stats")
def hail_clusters(spark, sf):
    return hail.hail_clusters(fx(spark, sf, "fx_hail"))


@query("hail_clusters_by_state", f"""with {ctes("fx_hail")},
{dbscan_sql("lab", "fx_hail", 0.03, 6, by="state")}
select l.state, l.label as cluster_id, count(*) as num_points, min(h.valid) as start_time, max(h.valid) as end_time,
 min(l.lon) as xmin, min(l.lat) as ymin, max(l.lon) as xmax, max(l.lat) as ymax
from lab l join fx_hail h on h.id = l.id where l.label >= 0 group by l.state, l.label""")
def hail_clusters_by_state(spark, sf):
    return hail.hail_clusters(fx(spark, sf, "fx_hail"), by=["state"])


@query("hail_noise_points", f"with {HAIL} select id, lon, lat from lab where label < 0")
def hail_noise_points(spark, sf):
    return hail.label_hail(fx(spark, sf, "fx_hail")).where("cluster_id < 0").select("id", "lon", "lat")


@query("hail_cluster_hulls", f"""with {STORMS}, {ring_sql('edge', 'cluster_id')}
select e.cluster_id, any_value(ring) as ring, any_value(s.num_points) as num_points, 'polygon' as hull_kind,
 round(sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) / 2, 13) as area, any_value(xmin) as xmin, any_value(ymin) as ymin,
 any_value(xmax) as xmax, any_value(ymax) as ymax,
 round(any_value(xmin) + sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ax + bx - 2 * xmin))
  / (3 * sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin))), 6) as cx,
 round(any_value(ymin) + sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ay + by_ - 2 * ymin))
  / (3 * sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin))), 6) as cy
from edge e join stats s on s.cluster_id = e.cluster_id join edge_ring r on r.cluster_id = e.cluster_id group by e.cluster_id""")
def hail_cluster_hulls(spark, sf):
    ring = F.col("ring")
    c = geo.centroid(ring)
    return storms(spark, sf).select(
        "cluster_id", ring_text(ring).alias("ring"), "num_points", "hull_kind", F.round(geo.area(ring), 13).alias("area"),
        "xmin", "ymin", "xmax", "ymax", F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


@query("storm_event_boundaries", f"""with {ctes("fx_storm_details")},
ok as (select * from fx_storm_details where BEGIN_LAT is not null and BEGIN_LON is not null),
{hull_sql("edge", "ok", ["EPISODE_ID", "EVENT_ID"], "BEGIN_LON", "BEGIN_LAT")},
{ring_sql("edge", "EPISODE_ID, EVENT_ID")},
corner as (select EPISODE_ID, EVENT_ID, min(ax) as x0, min(ay) as y0 from edge group by all),
area as (select EPISODE_ID, EVENT_ID, round(sum((ax - x0) * (by_ - y0) - (bx - x0) * (ay - y0)) / 2, 13) as area from edge join corner using (EPISODE_ID, EVENT_ID) group by all)
select o.EPISODE_ID, o.EVENT_ID as id, count(*) as num_points, min(BEGIN_DATE_TIME) as begin_time,
 arg_min(BEGIN_LON, line_no * 100000000 + row_key) as first_lon, arg_min(BEGIN_LAT, line_no * 100000000 + row_key) as first_lat,
 case when count(distinct (BEGIN_LON, BEGIN_LAT)) = 1 then 'point' when coalesce(any_value(area), 0) = 0 then 'line' else 'polygon' end as hull_kind,
 case when coalesce(any_value(area), 0) > 0 then any_value(ring) end as ring, coalesce(any_value(area), 0.0) as area, min(BEGIN_LON) as lon0, max(BEGIN_LON) as lon1, min(BEGIN_LAT) as lat0, max(BEGIN_LAT) as lat1
from ok o left join area a on a.EPISODE_ID = o.EPISODE_ID and a.EVENT_ID = o.EVENT_ID
left join edge_ring r on r.EPISODE_ID = o.EPISODE_ID and r.EVENT_ID = o.EVENT_ID group by o.EPISODE_ID, o.EVENT_ID""")
def storm_event_boundaries(spark, sf):
    b = hail.storm_event_boundaries(fx(spark, sf, "fx_storm_details"), ["line_no", "row_key"])
    flat = F.col("hull_kind") != "polygon"   # slivers around points and lines reach 1e-6 beyond them
    edge = lambda c, s: F.round(F.when(flat, F.col(c) + s * 1e-6).otherwise(F.col(c)), 6)
    return b.select("EPISODE_ID", "id", "num_points", "begin_time", "first_lon", "first_lat", "hull_kind",
                    F.when(~flat, ring_text(F.col("ring"))).alias("ring"), F.round(F.when(flat, 0.0).otherwise(F.col("area")), 13).alias("area"),
                    edge("xmin", 1).alias("lon0"), edge("xmax", -1).alias("lon1"),
                    edge("ymin", 1).alias("lat0"), edge("ymax", -1).alias("lat1"))


@query("degenerate_hulls", f"""with {ctes("fx_storm_details")},
ok as (select * from fx_storm_details where BEGIN_LAT is not null and BEGIN_LON is not null),
{hull_sql("edge", "ok", ["EVENT_ID"], "BEGIN_LON", "BEGIN_LAT")},
area as (select EVENT_ID from edge group by EVENT_ID
 having round(sum((ax - 0) * (by_ - 0) - (bx - 0) * (ay - 0)) / 2, 10) > 0),
e as (select EVENT_ID as id, min((BEGIN_LON, BEGIN_LAT)) as a, max((BEGIN_LON, BEGIN_LAT)) as b, count(distinct (BEGIN_LON, BEGIN_LAT)) as n
 from ok where EVENT_ID not in (select EVENT_ID from area) group by EVENT_ID)
select id, case n when 1 then 'point' else 'line' end as hull_kind,
 printf('%.6f %.6f', a[1], a[2]) || case when n > 1 then printf(',%.6f %.6f', b[1], b[2]) else '' end as ring,
 round(1e9 * (2e-6 * sqrt((b[1] - a[1]) * (b[1] - a[1]) + (b[2] - a[2]) * (b[2] - a[2])) + 32 * sin(pi() / 32) * 1e-12), 2) as area_e9 from e""")
def degenerate_hulls(spark, sf):
    ok = fx(spark, sf, "fx_storm_details").where("BEGIN_LAT is not null and BEGIN_LON is not null")
    flat = convex_hulls(ok, ["EVENT_ID"], "BEGIN_LON", "BEGIN_LAT").where("hull_kind <> 'polygon'")
    area = F.round(1e9 * geo.area(solid()), 2).alias("area_e9")
    return flat.select(F.col("EVENT_ID").alias("id"), "hull_kind", area, F.col("ring").alias("r")).select(
        "id", "hull_kind", "area_e9", ring_text(F.col("r")).alias("ring"))


@query("sql_hulls", f"""with {ctes("fx_storm_details")},
ok as (select * from fx_storm_details where BEGIN_LAT is not null and BEGIN_LON is not null),
{hull_sql("edge", "ok", ["EPISODE_ID"], "BEGIN_LON", "BEGIN_LAT")},
{ring_sql("edge", "EPISODE_ID")}
select o.EPISODE_ID as episode_id, coalesce(any_value(ring), printf('%.6f %.6f', min(BEGIN_LON), min(BEGIN_LAT))) as ring
from ok o left join edge_ring r on r.EPISODE_ID = o.EPISODE_ID group by o.EPISODE_ID""")
def sql_hulls(spark, sf):
    """Hulls in SQL, those of parts first where an episode has many points; a call per group is what costs."""
    sql.register(spark)
    fx(spark, sf, "fx_storm_details").where("BEGIN_LAT is not null and BEGIN_LON is not null").createOrReplaceTempView("hull_points")
    found = spark.sql("""
        WITH large AS (SELECT EPISODE_ID AS id, count(*) AS n FROM hull_points GROUP BY EPISODE_ID HAVING count(*) > 4096),
        parts AS (SELECT EPISODE_ID, sg_hull(BEGIN_LON, BEGIN_LAT) AS h FROM hull_points JOIN large ON EPISODE_ID <=> id
                  GROUP BY EPISODE_ID, pmod(xxhash64(BEGIN_LON, BEGIN_LAT), CAST(ceil(n / 4096) AS BIGINT))),
        corners AS (SELECT EPISODE_ID, inline(h) FROM parts)
        SELECT EPISODE_ID AS episode_id, sg_hull(x, y) AS h FROM corners GROUP BY EPISODE_ID
        UNION ALL
        SELECT EPISODE_ID, sg_hull(BEGIN_LON, BEGIN_LAT) FROM hull_points LEFT ANTI JOIN large ON EPISODE_ID <=> id GROUP BY EPISODE_ID""")
    return found.select("episode_id", ring_text(F.col("h")).alias("ring"))
