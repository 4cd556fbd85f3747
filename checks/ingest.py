"""Source, normalisation and union queries and their DuckDB twins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid.functions import geo, text, timing
from stormgrid.operators import rows
from stormgrid.session import checkpoint_root
from stormgrid.sources import addresses, parcels, products, vendor
from stormgrid.streaming import intake

from .inputs import ctes, fx, landed, table

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def first(*paths):
    return "coalesce(" + ", ".join(f"nullif(trim(json_extract_string(body, '$.properties.{p}')), '')" for p in paths) + ")"


NORMAL = f"""{ctes('fx_features')},
parts as (select row_id, {first('number', 'house_number', 'house', 'addr_num')} as number,
 {first('street', 'street_name', 'road', 'addr_street')} as street, {first('city', 'locality', 'town')} as city,
 {first('region', 'state')} as state, {first('postcode', 'postal_code', 'zip')} as zip,
 json_extract_string(body, '$.geometry.type') as kind, body from fx_features),
normal as (select row_id, concat_ws(', ', concat_ws(' ', number, street), city, state, zip) as address, number, street, city, state, zip,
 case kind when 'Point' then cast(json_extract(body, '$.geometry.coordinates[0]') as double) when 'Polygon' then 1.0 end as lon,
 case kind when 'Point' then cast(json_extract(body, '$.geometry.coordinates[1]') as double) when 'Polygon' then 0.5 end as lat
 from parts where (number is not null or street is not null) and kind in ('Point', 'Polygon'))"""


@query("normalize_addresses", f"with {NORMAL} select * from normal")
def normalize_addresses(spark, sf):
    return addresses.normalize_features(fx(spark, sf, "fx_features"), keep=("row_id",))


_HEAD = '{"type":"FeatureCollection","note":"\\\\ \\"features\\": [{","features":[{"type":"Feature","properties":{"features":[{}]},"geometry":null}'


def address_documents(spark, sf):
    """Twenty documents of one layout in four: one line, one feature a line, pretty-printed with CRLF, lines of features. File 18
    is cut off."""
    body = fx(spark, sf, "fx_features").select((F.col("row_id") % 20).alias("file"), F.col("row_id").alias("ord"), "body")
    layout = F.col("file") % 4
    edges = spark.range(20).select(F.col("id").alias("file"), F.explode(F.array(F.lit(-1), F.lit((1 << 62)))).alias("ord")).where(
        (layout != 3) & ((F.col("file") != 18) | (F.col("ord") < 0))).withColumn(
        "line", F.when(F.col("ord") < 0, F.lit(_HEAD)).otherwise('],"bbox":[{"a":[1]}]}'))
    pretty = F.regexp_replace(F.regexp_replace("body", ":", " :\n\t"), ",", "\r\n ,")
    line = F.when(layout == 3, F.col("body")).when(layout == 2, F.concat(F.lit(","), pretty)).otherwise(F.concat(F.lit(","), "body"))
    lines = body.select("file", "ord", line.alias("line")).unionByName(edges)
    return [landed(spark, lines.where(layout == 0), " "), landed(spark, lines.where((layout == 1) | (layout == 3))),
            landed(spark, lines.where(layout == 2), "\r\n")]


def _file_number():
    return F.regexp_extract("file_path", r"file=(\d+)/", 1).cast("int").alias("file_no")


@query("address_files_loaded", f"""with {NORMAL} select cast(row_id % 20 as integer) as file_no, address, number, street, city, state, zip, lon, lat
from normal where row_id % 20 <> 18""")
def address_files_loaded(spark, sf):
    found = addresses.read_addresses(spark, address_documents(spark, sf), "*")
    return found.withColumn("file_no", _file_number()).drop("file_path")


@query("import_log", f"""with {NORMAL}, held as (select row_id % 20 as f, count(*) as n from fx_features group by 1),
got as (select row_id % 20 as f, count(*) as n from normal group by 1)
select cast(f as integer) as file_no, case when f = 18 then 0 when f % 4 = 3 then held.n else held.n + 1 end as num_features,
 case when f = 18 then 0 else coalesce(got.n, 0) end as num_rows from held left join got using (f)""")
def import_log(spark, sf):
    out = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    for i, folder in enumerate(address_documents(spark, sf)):
        intake.ingest_addresses(spark, folder, f"{out}/t", f"{out}/c{i}", f"{out}/log{i}", names="*").awaitTermination()
    logs = reduce(DataFrame.unionByName, [spark.read.parquet(f"{out}/log{i}") for i in range(3)])
    return logs.select(_file_number(), "num_features", "num_rows")


_CORNER = ["(row_id % 50) * 100 as x", "(row_id % 37) * 50 as y"]


@query("parcel_pages", f"""with {ctes('fx_parcels')}, p as (select *, {', '.join(_CORNER)} from fx_parcels),
part as (select row_id, trim(PARID) as parid, x, y, 0 as part from p union all select row_id, trim(PARID), x + 60, y, 1 from p where row_id % 2 = 1)
select parid, count(*) as n_parts, min(x)::double as xmin, min(y)::double as ymin, max(x + 40)::double as xmax, max(y + 40)::double as ymax,
 cast(sum(case when part = 0 and row_id % 3 = 0 then 1 else 0 end) as integer) as n_holes from part
group by row_id, parid having bool_or(x <= 2500 and x + 40 >= 1030 and y <= 1400 and y + 40 >= 215)""")
def parcel_pages(spark, sf):
    src = fx(spark, sf, "fx_parcels").selectExpr("*", *_CORNER)
    square = "concat('[[', {0}, ',', {1}, '],[', {0} + {2}, ',', {1}, '],[', {0} + {2}, ',', {1} + {2}, '],[', {0}, ',', {1} + {2}, '],[', {0}, ',', {1}, ']]')"
    hole = f"if(row_id % 3 = 0, concat(',', {square.format('x + 5', 'y + 5', 10)}), '')"
    geometry = (f"if(row_id % 2 = 1, concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[[', {square.format('x', 'y', 40)}, {hole}, '],[', "
                f"{square.format('x + 60', 'y', 40)}, ']]}}'), concat('{{\"type\":\"Polygon\",\"coordinates\":[', {square.format('x', 'y', 40)}, {hole}, ']}}'))")
    feature = src.select((F.col("row_id") % 7).alias("file"), F.col("row_id").alias("ord"), F.concat(
        F.lit(',{"type":"Feature","properties":'), F.to_json(F.struct("PARID", "OWNER1", "MAIL_ADDR")), F.lit(',"geometry":'),
        F.expr(geometry), F.lit("}")).alias("line"))
    edges = spark.range(7).select(F.col("id").alias("file"), F.explode(F.array(F.lit(-1), F.lit(1 << 62))).alias("ord")).withColumn(
        "line", F.when(F.col("ord") < 0, F.lit(_HEAD)).otherwise("]}"))
    pages = parcels.read_parcel_pages(spark, landed(spark, feature.unionByName(edges)), "1030,215,2500,1400")
    return pages.select(F.trim(F.col("attributes")["PARID"]).alias("parid"), F.size("parts").cast("long").alias("n_parts"), "xmin", "ymin",
                        "xmax", "ymax", F.size(F.flatten("parts.holes")).alias("n_holes"))


@query("incremental_files", f"""with {ctes('fx_features')}
select file_path, count(*) as num_features from fx_features where file_path not in (select distinct file_path from fx_features where row_id % 60 < 7)
group by file_path""")
def incremental_files(spark, sf):
    files = fx(spark, sf, "fx_features")
    log = addresses.import_entries(files.where("row_id % 60 < 7"), F.lit("2024-01-01 00:00:00"))
    return addresses.new_files(files, log).groupBy("file_path").agg(F.count("*").alias("num_features"))


_FILE = "'StormEvents_details-ftp_v1.0_d' || cast(1990 + c_custkey % 30 as string) || '_c' || cast(20200000 + (c_custkey * 7919) % 10007 as string) || case when c_custkey % 17 = 0 then '.txt' else '.csv.gz' end"


@query("latest_release", f"""with f as (select {_FILE} as path from customer),
m as (select path, regexp_extract(path, 'd(\\d{{4}})_c(\\d{{8}})\\.csv\\.gz$', 1) as year, regexp_extract(path, 'd(\\d{{4}})_c(\\d{{8}})\\.csv\\.gz$', 2) as release from f)
select year, max(release) as release, arg_max(path, release) as path from m where year <> '' group by year""")
def latest_release(spark, sf):
    return products.latest_releases(table(spark, sf, "customer").select(F.expr(_FILE).alias("path")))


_P = """parcels as (select row_id, trim(PARID) as parcel_id, 'Jefferson' as county,
 trim(array_to_string(list_transform(regexp_extract_all(lower(OWNER1), '(\\p{L}+|[^\\p{L}]+)'), lambda t: upper(t[1]) || t[2:]), '')) as owner_name,
 trim(MAIL_ADDR) as mailing_address, try_cast(ASSESSED as double) as assessed_value from fx_parcels
 where trim(PARID) is not null and trim(PARID) not in ('', 'nan', 'None'))"""


@query("parcels_normalized", f"with {ctes('fx_parcels')},\n{_P} select * from parcels")
def parcels_normalized(spark, sf):
    return parcels.normalize_parcels(fx(spark, sf, "fx_parcels"), keep=("row_id",)).drop("raw")


@query("parcel_snapshots", f"""with {ctes('fx_parcels')} select row_id, json_extract_string(r, '$.PARID') as parid, json_extract_string(r, '$.OWNER1') as owner
 from (select row_id, to_json(p) as r, PARID from fx_parcels p) where trim(PARID) is not null and trim(PARID) <> ''""")
def parcel_snapshots(spark, sf):
    out = parcels.normalize_parcels(fx(spark, sf, "fx_parcels"), keep=("row_id",))
    return out.select("row_id", F.get_json_object("raw", "$.PARID").alias("parid"), F.get_json_object("raw", "$.OWNER1").alias("owner"))


@query("parcels_upsert", f"""with {ctes('fx_parcels')},
{_P},
old as (select * exclude (row_id) from parcels where row_id % 3 <> 0 qualify row_number() over (partition by parcel_id order by row_id desc) = 1),
new as (select * exclude (row_id) from parcels where row_id % 3 = 0 or row_id % 2 = 0 qualify row_number() over (partition by parcel_id order by row_id desc) = 1)
select * from new union all select * from old where parcel_id not in (select parcel_id from new)""")
def parcels_upsert(spark, sf):
    p = parcels.normalize_parcels(fx(spark, sf, "fx_parcels"), keep=("row_id",)).drop("raw")
    old = rows.pick_per_key(p.where("row_id % 3 <> 0"), [F.col("parcel_id")], F.col("row_id"), last=True).drop("row_id")
    return rows.upsert(old, p.where("row_id % 3 = 0 or row_id % 2 = 0"), ["parcel_id"], F.col("row_id"))


@query("owners_insert", f"""with {ctes('fx_parcels')},
{_P},
owners as (select row_id, parcel_id, owner_name as name, mailing_address from parcels where owner_name is not null),
old as (select distinct parcel_id, name from owners where row_id % 3 = 0)
select parcel_id, name, mailing_address from owners o where not exists (select 1 from old where old.parcel_id = o.parcel_id and old.name = o.name)
qualify row_number() over (partition by parcel_id, name order by row_id) = 1""")
def owners_insert(spark, sf):
    p = parcels.normalize_parcels(fx(spark, sf, "fx_parcels"), keep=("row_id",))
    owners = parcels.owners_of(p, keep=("row_id",))
    old = owners.where("row_id % 3 = 0").select("parcel_id", "name")
    return rows.absent_rows(old, owners, ["parcel_id", "name"], F.col("row_id")).select("parcel_id", "name", "mailing_address")


@query("osm_addresses", """with n as (select event_id as id, (event_id * 7919 % 90000) / 1000.0 as lat, user_id as num, event_id % 4 as m from events where event_id % 5 <> 0)
select id, case when m = 0 then cast(num as varchar) || ' Oak Ave' when m = 1 then cast(num as varchar) || ' Elm, Town, KY 40001'
 when m = 2 then cast(num as varchar) || ' Elm, , KY' else cast(num as varchar) end as address, cast(lat as double) as lat, cast(-lat as double) as lon from n""")
def osm_addresses(spark, sf):
    num, m = F.col("user_id").cast("string"), F.col("event_id") % 4
    pair = lambda k, v: F.create_map(F.lit(f"addr:{k}"), v)
    house = F.when(F.col("event_id") % 5 == 0, F.create_map(F.lit("shop"), F.lit("yes"))).otherwise(pair("housenumber", num))
    more = (F.when(m == 0, pair("street", F.lit("Oak Ave")))
            .when(m == 1, F.map_concat(pair("street", F.lit("Elm")), pair("city", F.lit("Town")), pair("state", F.lit("KY")), pair("postcode", F.lit("40001"))))
            .when(m == 2, F.map_concat(pair("street", F.lit("Elm")), pair("state", F.lit("KY"))))
            .otherwise(F.create_map(F.lit("note"), F.lit("x"))))
    lat = (F.col("event_id") * 7919 % 90000) / F.lit(1000.0)
    nodes = table(spark, sf, "events").select(F.col("event_id").alias("id"), lat.alias("lat"), (-lat).alias("lon"),
                                              F.map_concat(house, more).alias("tags"))
    return addresses.osm_addresses(nodes)


@query("vendor_columns", f"""with {ctes('fx_addresses')} select coalesce(address, '') as address, city, state, zip from fx_addresses where trim(coalesce(address, '')) <> ''""")
def vendor_columns(spark, sf):
    return vendor.vendor_columns(fx(spark, sf, "fx_addresses"))


@query("address_csv_aliases", f"""with {ctes('fx_addresses')}
select id, coalesce(case when id % 3 = 0 then null else street end, address) as street, city, state, zip from fx_addresses
 where trim(coalesce(case when id % 3 = 0 then null else street end, address)) <> '' and trim(city) <> ''""")
def address_csv_aliases(spark, sf):
    src = fx(spark, sf, "fx_addresses").select(
        "id", F.col("address").alias("Address "), F.when(F.col("id") % 3 != 0, F.col("street")).alias("STREET"),
        F.col("city").alias("City_Name"), F.col("state").alias("state_code"), F.col("zip").alias("ZipCode"))
    return addresses.complete(addresses.canonical_headers(src))


@query("hail_in_bbox_dates", f"""with {ctes('fx_hail')} select id, valid, lon, lat from fx_hail
 where valid >= timestamp '2024-01-05' and valid <= timestamp '2024-02-20' and lon between -89.45 and -87.2 and lat between 30.4 and 30.9""")
def hail_in_bbox_dates(spark, sf):
    return products.date_or_box(fx(spark, sf, "fx_hail"), start="2024-01-05", end="2024-02-20", box="-89.45,30.4,-87.2,30.9",
                                day="valid").select("id", "valid", "lon", "lat")


@query("hail_date_chunks", f"""with {ctes('fx_hail')} select cast(floor(date_diff('day', date '2024-01-01', cast(valid as date)) / 30) as integer) as chunk,
 cast(date '2024-01-01' + cast(floor(date_diff('day', date '2024-01-01', cast(valid as date)) / 30) * 30 as integer) as date) as chunk_start, state, count(*) as num_points
 from fx_hail where valid >= timestamp '2024-01-01' and valid < timestamp '2025-08-01' group by all""")
def hail_date_chunks(spark, sf):
    placed = timing.in_chunks(fx(spark, sf, "fx_hail"), "valid", "2024-01-01", "2025-08-01", 30)
    return placed.groupBy("chunk", "chunk_start", "state").agg(F.count("*").alias("num_points"))


@query("union_windows", f"""with {ctes('fx_hail')} select state, count(*) as num_points, min(id) as first_id, max(id) as last_id
 from fx_hail where valid >= timestamp '2024-01-03' group by state""")
def union_windows(spark, sf):
    h = fx(spark, sf, "fx_hail")
    parts = [h.where("id % 3 = 0"), h.where("id % 3 <= 1"), h.where("id % 3 >= 1")]     # overlapping windows
    run = rows.union_windows(parts, ["state", "id"]).where(F.col("valid") >= F.lit("2024-01-03").cast("timestamp_ntz"))
    return run.groupBy("state").agg(F.count("*").alias("num_points"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("recent_storms", f"""with {ctes('fx_storm_details')} select EVENT_ID as id, BEGIN_DATE_TIME as event_time, strftime(BEGIN_DATE_TIME, '%m-%d %H:%M') as label, row_key
 from fx_storm_details where BEGIN_DATE_TIME >= timestamp '1998-06-01' - interval 14 day order by event_time desc, id, row_key limit 50""")
def recent_storms(spark, sf):
    d = timing.recent(fx(spark, sf, "fx_storm_details"), "BEGIN_DATE_TIME", "1998-06-01", 14)
    out = d.select(F.col("EVENT_ID").alias("id"), F.col("BEGIN_DATE_TIME").alias("event_time"),
                   timing.label("BEGIN_DATE_TIME").alias("label"), "row_key")
    return rows.top(out, 50, F.desc("event_time"), F.asc("id"), F.asc("row_key"))


@query("sample_rows", f"with {ctes('fx_storm_details')} select * from fx_storm_details order by EVENT_ID, line_no, row_key limit 5")
def sample_rows(spark, sf):
    return rows.top(fx(spark, sf, "fx_storm_details"), 5, F.asc("EVENT_ID"), F.asc("line_no"), F.asc("row_key"))


@query("publish_aligned", f"""with {ctes('fx_hail')} select cast(id as integer) as id, valid, cast(lon as double) as lon, cast(null as varchar) as note, maxsize from fx_hail""")
def publish_aligned(spark, sf):
    target = spark.createDataFrame([], "id int, VALID timestamp_ntz, lon double, note string")
    h = fx(spark, sf, "fx_hail").select("id", "valid", "lon", "maxsize")
    return rows.align(h, rows.evolve(target, h)).withColumnRenamed("VALID", "valid")


@query("hail_map_points", f"""with {ctes('fx_hail')},
 m as (select max(maxsize) as big, min(sevprob) as lo, max(sevprob) as hi from fx_hail)
select id, case when coalesce(maxsize, 0) = 0 then 3.0 else round(maxsize * (5.0 / big), 6) end as radius, round((sevprob - lo) / cast(hi - lo as double), 6) as severity
 from fx_hail, m""")
def hail_map_points(spark, sf):
    from stormgrid.plans import maps
    p = maps.hail_markers(fx(spark, sf, "fx_hail"))
    return p.select("id", F.round("radius", 6).alias("radius"), F.round("severity", 6).alias("severity"))


@query("features_to_bbox", f"with {NORMAL} select row_id from normal where lon between -85.6 and 1.5 and lat between 0 and 40")
def features_to_bbox(spark, sf):
    n = addresses.normalize_features(fx(spark, sf, "fx_features"), keep=("row_id",))
    return n.where(geo.in_box("lon", "lat", -85.6, 0.0, 1.5, 40.0)).select("row_id")


@query("title_cased_owners", f"""with {ctes('fx_parcels')} select row_id, array_to_string(list_transform(regexp_extract_all(lower(OWNER1), '(\\p{{L}}+|[^\\p{{L}}]+)'),
 lambda t: upper(t[1]) || t[2:]), '') as owner from fx_parcels""")
def title_cased_owners(spark, sf):
    return fx(spark, sf, "fx_parcels").select("row_id", text.title_case("OWNER1").alias("owner"))
