"""Property, lead, run, map and job-event queries and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stormgrid.functions import geo, payload, text
from stormgrid.operators import qualify, rows
from stormgrid.plans import maps
from stormgrid.session import checkpoint_root
from stormgrid.sinks import tables
from stormgrid.sources import vendor
from stormgrid.streaming import intake, jobs

from .hail import storms
from .inputs import ctes, fx, landed
from .oracle_parts import STORMS, ring_sql, ring_text

QUERIES, SQL = {}, {}
CAP = 1_000_000


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def js(path):
    return f"json_extract_string(body, '$.{path}')"


FLAT = f"""{ctes('fx_vendor_json')},
flat as (select request_id, {js('_id')} as property_id, coalesce(nullif({js('address.street')}, ''), nullif({js('address.streetNoUnit')}, '')) as street,
 {js('address.city')} as city, {js('address.state')} as state, {js('address.zip')} as zip,
 cast({js('assessment.totalAssessedValue')} as bigint) as total_assessed_value, cast({js('owner.ownerOccupied')} as boolean) as owner_occupied,
 cast({js('general.vacant')} as boolean) as vacant, coalesce({js('address.streetNoUnit')}, '') as plain, body from fx_vendor_json)"""


def props(spark, sf):
    return vendor.parse_properties(fx(spark, sf, "fx_vendor_json"))


@query("properties_flat", f"with {FLAT} select * exclude (plain, body), cast(null as varchar) as county, cast(null as integer) as year_built from flat")
def properties_flat(spark, sf):
    return vendor.flatten_properties(props(spark, sf), keep=("request_id",)).select(
        "request_id", "property_id", "street", "city", "state", "zip", "total_assessed_value", "owner_occupied", "vacant",
        "county", "year_built")


CONTACTS = f"""{FLAT},
contacts as (select property_id, e as email, null as phone, null as phone_type, null as score, null as dnc
 from (select distinct property_id, unnest(cast(json_extract(body, '$.owner.emails') as varchar[])) as e from flat) where e <> ''
union all
select property_id, null, json_extract_string(p, '$.number'), json_extract_string(p, '$.type'), cast(json_extract_string(p, '$.score') as integer), cast(json_extract_string(p, '$.dnc') as boolean)
 from (select property_id, unnest(cast(json_extract(body, '$.owner.phoneNumbers') as json[])) as p from flat))"""


@query("owner_contacts", f"with {CONTACTS} select * from contacts")
def owner_contacts(spark, sf):
    return vendor.contacts(props(spark, sf)).select("property_id", "email", "phone", "phone_type", "score", "dnc")


@query("contacts_insert", f"""with {CONTACTS} select property_id, email, phone, dnc from contacts c
 where not (substr(property_id, length(property_id), 1) in ('1', '2', '3') and email is not null)""")
def contacts_insert(spark, sf):
    new = vendor.contacts(props(spark, sf))
    old = new.where("email is not null").where(F.substring("property_id", -1, 1).isin("1", "2", "3"))
    out = rows.absent_rows(old, new, ["property_id", "email", "phone"], F.coalesce("phone", "email"))
    return out.select("property_id", "email", "phone", "dnc")


@query("masked_contacts", f"""with {CONTACTS} select property_id, dnc,
 case when length(email) <= 8 then repeat('…', length(email)) else left(email, 4) || '…' || right(email, 4) end as email,
 case when length(phone) <= 8 then repeat('…', length(phone)) else left(phone, 4) || '…' || right(phone, 4) end as phone from contacts""")
def masked_contacts(spark, sf):
    return vendor.contacts(props(spark, sf)).select(
        "property_id", "dnc", text.mask_middle("email").alias("email"), text.mask_middle("phone").alias("phone"))


@query("contact_arrays", f"""with {CONTACTS} select property_id, coalesce(string_agg(email, ';' order by email), '') as emails,
 coalesce(string_agg(phone || ':' || phone_type || ':' || cast(score as varchar) || ':' || cast(dnc as varchar), ';' order by phone), '') as phones
 from contacts group by property_id""")
def contact_arrays(spark, sf):
    a = vendor.contact_arrays(vendor.contacts(props(spark, sf)))
    return a.select("property_id", F.array_join("emails", ";").alias("emails"), F.array_join(F.transform(
        "phones", lambda p: F.concat_ws(":", p["phone"], p["phone_type"], p["score"], p["dnc"])), ";").alias("phones"))


@query("selector_full", f"""with {CONTACTS},
arrays as (select property_id, string_agg(email, ';' order by email) as emails,
 string_agg(case when length(phone) <= 8 then repeat('…', length(phone)) else left(phone, 4) || '…' || right(phone, 4) end || ':' || cast(dnc as varchar), ';' order by phone) as phones
 from contacts group by property_id)
select f.property_id, f.street, f.city, f.state, f.zip, f.total_assessed_value, f.owner_occupied, f.vacant, a.emails, a.phones
from flat f left join arrays a on a.property_id = f.property_id
where f.owner_occupied and not coalesce(f.vacant, false) and coalesce(f.total_assessed_value, 0) <= {CAP}
order by f.total_assessed_value desc nulls last, f.property_id limit 1000""")
def selector_full(spark, sf):
    parsed = props(spark, sf)
    out = qualify.with_contacts(qualify.leads_lenient(vendor.flatten_properties(parsed), CAP, 1000), vendor.contacts(parsed))
    phones = F.transform("phones", lambda p: F.concat_ws(":", p["phone"], p["dnc"]))
    return out.select("property_id", "street", "city", "state", "zip", "total_assessed_value", "owner_occupied", "vacant",
                      F.array_join("emails", ";").alias("emails"), F.array_join(phones, ";").alias("phones"))


_SEARCH = """'{"externalId":"' || cast(o_orderkey as string) || '","property":{"parcelId":"R' || cast(o_orderkey % 1000 as string) || '","sqFt":' || cast(900 + o_orderkey % 3000 as string)
 || ',"yearBuilt":' || cast(1900 + o_orderkey % 120 as string) || ',"assessedValue":' || (case when o_orderkey % 5 = 0 then 'null' else cast(o_orderkey % 900000 as string) end) || '},"owners":['
 || (case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then '{"name":"N1","phone":"5551","email":"a@example.com","mailingAddress":"1 A"}' else '{"name":"N1","phone":null},{"name":"N2","email":"b@example.com"}' end) || ']}'"""


@query("search_properties", f"""with s as (select {_SEARCH} as body from orders)
select cast({js('externalId')} as bigint) as address_id, {js('property.parcelId')} as parcel_id, cast({js('property.sqFt')} as integer) as sq_ft,
 cast({js('property.yearBuilt')} as integer) as year_built, cast({js('property.assessedValue')} as double) as assessed_value,
 {js('property.parcelId')} as raw_parcel, cast(json_array_length(body, '$.owners') as integer) as raw_owners from s""")
def search_properties(spark, sf):
    from .inputs import table
    src = table(spark, sf, "orders").select(F.expr(_SEARCH).alias("body"))
    raw = lambda path: F.get_json_object("metadata", path)
    return vendor.search_properties(vendor.parse_results(src)).withColumns({
        "raw_parcel": raw("$.property.parcelId"), "raw_owners": F.json_array_length(raw("$.owners"))}).drop("metadata")


@query("search_owners", f"""with s as (select {_SEARCH} as body from orders),
o as (select cast({js('externalId')} as bigint) as address_id, unnest(cast(json_extract(body, '$.owners') as json[])) as o from s)
select address_id, json_extract_string(o, '$.name') as name, json_extract_string(o, '$.phone') as phone, json_extract_string(o, '$.email') as email,
 json_extract_string(o, '$.mailingAddress') as mailing_address, json_extract_string(o, '$.email') as raw_email from o""")
def search_owners(spark, sf):
    from .inputs import table
    src = table(spark, sf, "orders").select(F.expr(_SEARCH).alias("body"))
    return vendor.search_owners(vendor.parse_results(src)).withColumn("raw_email", F.get_json_object("metadata", "$.email")).drop("metadata")


@query("leads_strict", f"""with {ctes('fx_properties')}, v as (select *, coalesce(cast(total_market_value as double), cast(total_assessed_value as double)) as value_used from fx_properties)
select property_id, value_used, owner_occupied, vacant from v where owner_occupied and not vacant and value_used <= {CAP} order by value_used desc, property_id limit 1000""")
def leads_strict(spark, sf):
    out = qualify.leads_strict(fx(spark, sf, "fx_properties"), CAP, 1000, ("property_id",))
    return out.select("property_id", "value_used", "owner_occupied", "vacant")


@query("leads_lenient", f"""with {ctes('fx_properties')} select property_id, total_assessed_value, owner_occupied, vacant from fx_properties
 where owner_occupied and not coalesce(vacant, false) and coalesce(total_assessed_value, 0) <= {CAP} order by total_assessed_value desc nulls last, property_id limit 1000""")
def leads_lenient(spark, sf):
    out = qualify.leads_lenient(fx(spark, sf, "fx_properties"), CAP, 1000)
    return out.select("property_id", "total_assessed_value", "owner_occupied", "vacant")


@query("leads_mixed", f"""with {ctes('fx_properties')} select property_id, total_assessed_value from fx_properties
 where coalesce(owner_occupied, false) and not coalesce(vacant, false) and coalesce(total_assessed_value, 0) between 1 and {CAP}
 order by total_assessed_value desc nulls last, property_id limit 1000""")
def leads_mixed(spark, sf):
    return qualify.leads_mixed(fx(spark, sf, "fx_properties"), CAP, 1000).select("property_id", "total_assessed_value")


@query("qualified_counts", f"""with {ctes('fx_properties')}, v as (select *, coalesce(cast(total_market_value as double), cast(total_assessed_value as double)) as value_used from fx_properties)
select count(*) as num_rows, count(*) filter (owner_occupied and not vacant and value_used <= {CAP}) as num_strict,
 count(*) filter (owner_occupied and not coalesce(vacant, false) and coalesce(total_assessed_value, 0) <= {CAP}) as num_lenient,
 count(*) filter (coalesce(owner_occupied, false) and not coalesce(vacant, false) and coalesce(total_assessed_value, 0) between 1 and {CAP}) as num_mixed from v""")
def qualified_counts(spark, sf):
    v = fx(spark, sf, "fx_properties").withColumn("value_used", qualify.value_used())
    return v.agg(F.count("*").alias("num_rows"), F.count_if(qualify.strict(CAP)).alias("num_strict"),
                 F.count_if(qualify.lenient(CAP)).alias("num_lenient"), F.count_if(qualify.mixed(CAP)).alias("num_mixed"))


def geodesic_sql(lon, lat):
    return f"""g as (select *, (radians(lat) + radians({lat})) / 2 as f, (radians(lat) - radians({lat})) / 2 as g, (radians(lon) - radians({lon})) / 2 as l from located),
s as (select *, sin(g) * sin(g) * cos(l) * cos(l) + cos(f) * cos(f) * sin(l) * sin(l) as s, cos(g) * cos(g) * cos(l) * cos(l) + sin(f) * sin(f) * sin(l) * sin(l) as c from g),
w as (select *, atan(sqrt(s / c)) as w, sqrt(s * c) / atan(sqrt(s / c)) as r from s where s > 0),
dist as (select *, 2 * w * 6378137.0 * (1 + (1 / 298.257223563) * ((3 * r - 1) / (2 * c) * sin(f) * sin(f) * cos(g) * cos(g) - (3 * r + 1) / (2 * s) * cos(f) * cos(f) * sin(g) * sin(g))) as d from w)"""


@query("leads_in_radius", f"""with {ctes('fx_addresses', 'fx_properties')}, located as (select p.*, a.lon, a.lat from fx_properties p join fx_addresses a on a.id = p.address_id),
{geodesic_sql(-88.9, 30.5)}
select property_id, lon as longitude, lat as latitude, total_assessed_value, round(d, 1) as distance_m from dist where d <= 60000 and owner_occupied and not coalesce(vacant, false)
 and coalesce(total_assessed_value, 0) <= {CAP} order by total_assessed_value desc nulls last, property_id limit 1000""")
def leads_in_radius(spark, sf):
    at = fx(spark, sf, "fx_addresses").select(F.col("id").alias("address_id"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"))
    located = fx(spark, sf, "fx_properties").join(at, "address_id")
    out = qualify.leads_in_radius(located, geo.parse_center("-88.9, 30.5"), 60.0, CAP, 1000)
    return out.select("property_id", "longitude", "latitude", "total_assessed_value",
                      F.round(geo.geodesic("longitude", "latitude", -88.9, 30.5), 1).alias("distance_m"))


@query("mailing_leads", f"""with {FLAT}, m as (select coalesce(nullif(plain, ''), street) as street, city, state, zip, owner_occupied, vacant, cast(total_assessed_value as double) as value_used from flat)
select street, city, state, zip, value_used from m where owner_occupied and not vacant and value_used <= {CAP} order by value_used desc, street limit 500""")
def mailing_leads(spark, sf):
    m = vendor.mailing_rows(props(spark, sf))
    out = rows.top(m.where(qualify.strict(CAP)), 500, *qualify.by_value("value_used", "street"))
    return out.select("street", "city", "state", "zip", "value_used")


@query("request_batches", f"""with {ctes('fx_addresses')}, n as (select *, (row_number() over (order by id) - 1) // 50 as batch_id from fx_addresses where address is not null)
select batch_id, count(*) as num_rows, '{{"requests":[' || string_agg('{{"address":{{"street":"' || address || '","city":"' || city || '","state":"' || state || '","zip":"' || zip || '"}}}}', ',' order by id)
 || '],"options":{{"skipTrace":true}}}}' as payload from n group by batch_id""")
def request_batches(spark, sf):
    a = fx(spark, sf, "fx_addresses").where("address is not null")
    b = rows.batches(a, ["id"], 50, vendor.lookup_entry(street="address"))
    return b.select("batch_id", "num_rows", vendor.lookup_payload().alias("payload"))


@query("search_batches", f"""with {ctes('fx_addresses')}, n as (select *, (row_number() over (order by id) - 1) // 100 as batch_id from fx_addresses)
select batch_id, count(*) as num_rows, '{{"addresses":[' || string_agg('{{"line1":"' || number || ' ' || street || '","city":"' || city || '","state":"' || state || '","postalCode":"' || zip
 || '","externalId":"' || cast(id as varchar) || '"}}', ',' order by id) || ']}}' as payload from n group by batch_id""")
def search_batches(spark, sf):
    b = rows.batches(fx(spark, sf, "fx_addresses"), ["id"], 100, vendor.search_entry())
    return b.select("batch_id", "num_rows", vendor.search_payload().alias("payload"))


@query("latest_run_per_state", f"with {ctes('fx_runs')} select * from fx_runs qualify row_number() over (partition by state order by created_seq desc, run_id desc) = 1")
def latest_run_per_state(spark, sf):
    return rows.latest_per(fx(spark, sf, "fx_runs"), "state", F.struct("created_seq", "run_id"))


@query("run_by_id", f"with {ctes('fx_runs')} select * from fx_runs where run_id = 77")
def run_by_id(spark, sf):
    from stormgrid.sources.tables import run_row
    return run_row(fx(spark, sf, "fx_runs"), 77)


@query("runs_coalesce_update", f"""with {ctes('fx_runs')}, up as (select run_id, case run_id % 4 when 0 then '' when 1 then null else 'NEW' || cast(run_id as varchar) end as batch_job_id from fx_runs where run_id % 2 = 0 or run_id % 4 = 1)
select r.run_id, coalesce(nullif(u.batch_job_id, ''), r.batch_job_id) as batch_job_id, case when u.run_id is not null then timestamp '2024-05-01' end as submitted_at
 from fx_runs r left join up u on u.run_id = r.run_id""")
def runs_coalesce_update(spark, sf):
    runs = fx(spark, sf, "fx_runs").select("run_id", "batch_job_id", F.lit(None).cast("timestamp_ntz").alias("submitted_at"))
    m = F.col("run_id") % 4
    up = runs.where("run_id % 2 = 0 or run_id % 4 = 1").select("run_id", F.when(m == 0, "").when(m != 1, F.concat(F.lit("NEW"), F.col("run_id"))).alias("batch_job_id"))
    return rows.coalesce_update(runs, up, "run_id", ["batch_job_id"], {"submitted_at": F.expr("TIMESTAMP_NTZ '2024-05-01 00:00:00'")})


EVENTS = f"""{ctes('fx_webhook')},
j as (select event_id, received_at, body, case when json_valid(body) then cast(body as json) end as p from fx_webhook),
c as (select *, case when json_type(p, '$.jobId') in ('VARCHAR', 'UBIGINT', 'BIGINT') then json_extract_string(p, '$.jobId') when json_type(p, '$.job_id') in ('VARCHAR', 'UBIGINT', 'BIGINT') then json_extract_string(p, '$.job_id')
  when json_type(p, '$.id') in ('VARCHAR', 'UBIGINT', 'BIGINT') then json_extract_string(p, '$.id') end as top,
 coalesce(json_extract_string(p, '$.data.jobId'), json_extract_string(p, '$.data.job_id'), json_extract_string(p, '$.data.id')) as inner_id from j),
ev as (select event_id, received_at, coalesce(nullif(top, ''), inner_id, top) as job_id,
 case when json_type(p, '$.status') = 'OBJECT' then json_extract_string(p, '$.status.text') when json_type(p, '$.status') in ('VARCHAR', 'UBIGINT', 'BIGINT') then json_extract_string(p, '$.status')
  else json_extract_string(p, '$.data.status') end as status,
 case when json_type(p, '$.event') = 'VARCHAR' then json_extract_string(p, '$.event') when json_type(p, '$.type') = 'VARCHAR' then json_extract_string(p, '$.type') end as event_type,
 case when p is null then '{{"raw":"' || body || '"}}' else body end as payload from c)"""


@query("webhook_events", f"with {EVENTS} select * from ev")
def webhook_events(spark, sf):
    return jobs.parse_events(fx(spark, sf, "fx_webhook"), keep=("event_id",))


@query("submit_job_ids", f"""with {EVENTS} select event_id, coalesce(nullif(json_extract_string(p, '$.data.jobId'), ''), json_extract_string(p, '$.data.id'), json_extract_string(p, '$.jobId'), json_extract_string(p, '$.id'), json_extract_string(p, '$.job_id')) as submit_id,
 coalesce(nullif(coalesce(json_extract_string(p, '$.id'), json_extract_string(p, '$.jobId'), json_extract_string(p, '$.job_id')), ''), json_extract_string(p, '$.data.id'), json_extract_string(p, '$.data.jobId'), '') as driver_id from c""")
def submit_job_ids(spark, sf):
    v = payload.parse("body")
    return fx(spark, sf, "fx_webhook").select("event_id", payload.submit_job_id(v).alias("submit_id"), payload.driver_job_id(v).alias("driver_id"))


@query("job_latest_status", f"""with {EVENTS} select job_id, arg_max(status, (received_at, event_id)) as status, max(received_at) as received_at, count(*) as num_events
 from ev where job_id is not null group by job_id""")
def job_latest_status(spark, sf):
    ev = jobs.parse_events(fx(spark, sf, "fx_webhook"), keep=("event_id",))
    return jobs.latest_status(ev, "event_id")


@query("overdue_jobs", f"""with {EVENTS}, l as (select job_id, min(received_at) as first_seen, bool_or(coalesce(status, '') in ('complete', 'failed', 'Completed', 'Failed', 'Error')) as finished
 from ev where job_id is not null and received_at <= timestamp '2024-01-03' group by job_id)
select job_id, first_seen from l where not finished and first_seen < timestamp '2024-01-03' - interval 300 second""")
def overdue_jobs(spark, sf):
    ev = jobs.parse_events(fx(spark, sf, "fx_webhook"), keep=("event_id",))
    return jobs.overdue(ev, "2024-01-03 00:00:00", 300)


def landed_events(spark, sf, last=None):
    """Event records in five files, none in the order of time; ``last`` is the time of one more record, without a job."""
    record = F.to_json(F.struct("received_at", F.create_map(F.lit("h"), F.lit("v")).alias("headers"), "body"),
                       {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    lines = fx(spark, sf, "fx_webhook").select(F.pmod(F.xxhash64("event_id"), F.lit(5)).alias("file"),
                                               F.xxhash64("body", "event_id").alias("ord"), record.alias("line"))
    path = landed(spark, lines)
    if last:
        text = f'{{"received_at":"{last}","headers":{{}},"body":"no job"}}'
        spark.range(1).select(F.lit(9).alias("file"), F.lit(text).alias("line")).write.mode("append").partitionBy("file").text(path)
    return path


@query("status_stream", f"""with {EVENTS} select job_id, status, received_at from ev where job_id is not null
qualify row_number() over (partition by job_id order by received_at desc, status desc nulls last) = 1""")
def status_stream(spark, sf):
    events = intake.parsed_events(intake.read_events(spark, landed_events(spark, sf), 2))
    out = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    intake.keep_latest_status(events, f"{out}/changes", f"{out}/c").awaitTermination()
    return intake.current_status(spark, f"{out}/changes").select("job_id", "status", "received_at")


@query("overdue_stream", f"""with {EVENTS}, f as (select job_id, min(received_at) as first_seen from ev where job_id is not null group by job_id)
select job_id, first_seen from f where not exists (select 1 from ev e where e.job_id = f.job_id
 and e.status in ('complete', 'failed', 'Completed', 'Failed', 'Error') and e.received_at <= f.first_seen + interval 300 second)""")
def overdue_stream(spark, sf):
    events = intake.parsed_events(intake.read_events(spark, landed_events(spark, sf, "2100-01-01T00:00:00"), 2))
    out = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    run = (intake.overdue_stream(events, 300, "3650 days").writeStream.format("parquet").option("path", f"{out}/late")
           .option("checkpointLocation", f"{out}/c").outputMode("append").start())
    run.processAllAvailable()
    run.stop()
    return spark.read.schema("job_id string, first_seen timestamp_ntz").parquet(f"{out}/late")


@query("trace_results", f"""with {EVENTS}, d as (select job_id, received_at, event_id % 2 as odd from ev
 where job_id is not null and status in ('complete', 'failed', 'Completed', 'Failed', 'Error')),
l as (select job_id, coalesce(min(received_at) filter (odd = 0), min(received_at)) as completed_at from d group by job_id)
select 10 * cast(job_id as bigint) + k as address_id, job_id as batch_job_id, completed_at from l, (select unnest([0, 1]) as k)""")
def trace_results(spark, sf):
    """Stored in two goes, the second with events that were there before; read back from the table."""
    ev = jobs.parse_events(fx(spark, sf, "fx_webhook"), keep=("event_id",))
    where = ev.where("job_id is not null").select("job_id").distinct().select(
        "job_id", F.explode(F.array(*[10 * F.col("job_id").cast("long") + k for k in (0, 1)])).alias("address_id"))
    path = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    for part in (ev.where("event_id % 2 = 0"), ev):
        tables.store_traces(part, where, path)
    return spark.read.parquet(path).select("address_id", "batch_job_id", "completed_at")


@query("run_log_rows", f"""with {ctes('fx_runs')} select state, 'export' as step, count(*) as runs,
 sum(case when batch_job_id is null then 1 else 0 end)::bigint as open from fx_runs group by state""")
def run_log_rows(spark, sf):
    """A log line per state, written and read back."""
    path = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    found = fx(spark, sf, "fx_runs").groupBy("state").agg(F.count("*").alias("n"), F.count_if(F.col("batch_job_id").isNull()).alias("open"))
    for r in found.collect():          # four states
        tables.log_step(spark, path, "2024-01-01 00:00:00", r.state, "export", "ok", f"{r.n}/{r.open}")
    note = F.split("note", "/")
    return spark.read.parquet(path).select("state", "step", note[0].cast("long").alias("runs"), note[1].cast("long").alias("open"))


@query("counted_appends", f"""with {ctes('fx_runs')} select state, count(*) * 2 as num_rows, max(created_seq) as newest from fx_runs group by state""")
def counted_appends(spark, sf):
    """A table replaced, then appended to by its own count; read back."""
    path = f"{checkpoint_root(spark).rstrip('/')}/derived/{uuid.uuid4().hex}"
    runs = fx(spark, sf, "fx_runs")
    tables.replace(runs.limit(1), path)
    tables.replace(runs, path)
    if tables.append_counted(runs, path) != runs.count():
        raise ValueError("the count of rows appended is wrong")
    return spark.read.parquet(path).groupBy("state").agg(F.count("*").alias("num_rows"), F.max("created_seq").alias("newest"))


@query("map_bounds", f"with {STORMS} select min(xmin) as minx, min(ymin) as miny, max(xmax) as maxx, max(ymax) as maxy, (min(ymin) + max(ymax)) / 2 as center_lat, (min(xmin) + max(xmax)) / 2 as center_lon from stats")
def map_bounds(spark, sf):
    return maps.total_bounds(storms(spark, sf))


@query("map_centroid", f"""with {STORMS}, t as (select e.cluster_id, any_value(xmin) as x0, any_value(ymin) as y0, sum((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) as w,
 sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ax + bx - 2 * xmin)) as sx, sum(((ax - xmin) * (by_ - ymin) - (bx - xmin) * (ay - ymin)) * (ay + by_ - 2 * ymin)) as sy
 from edge e join stats s on s.cluster_id = e.cluster_id group by e.cluster_id)
select round(sum((x0 + sx / (3 * w)) * w) / sum(w), 6) as lon, round(sum((y0 + sy / (3 * w)) * w) / sum(w), 6) as lat from t""")
def map_centroid(spark, sf):
    return maps.joint_centroid(storms(spark, sf)).select(F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


_RECT = "(c_custkey * 37) % 100 as x, (c_custkey * 61) % 80 as y, 3 + c_custkey % 7 as w, 2 + c_custkey % 5 as h"


@query("union_centroid", f"""with r as (select {_RECT} from customer), units as (select distinct x + i as x, y + j as y from r, unnest(range(w)) a(i), unnest(range(h)) b(j))
select count(*)::double as area, round(avg(x + 0.5), 6) as lon, round(avg(y + 0.5), 6) as lat from units""")
def union_centroid(spark, sf):
    """Overlapping rectangles, counted once."""
    from .inputs import table
    at = lambda a, b: geo.vertex(F.expr(a).cast("double"), F.expr(b).cast("double"))
    ring = F.array(at("x", "y"), at("x + w", "y"), at("x + w", "y + h"), at("x", "y + h"), at("x", "y"))
    shapes = table(spark, sf, "customer").selectExpr(*_RECT.split(", ")).select(ring.alias("ring")).withColumns(geo.bounds(F.col("ring")))
    return maps.union_centroid(shapes).select(F.round("area", 6).alias("area"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("map_colors", f"""with {STORMS}, n as (select cluster_id, num_points, cast(cluster_id as bigint) as c from stats)
select cluster_id, num_points, '#' || lpad(lower(to_hex((c * 2654435761) & 16777215)), 6, '0') as color, '#' || lpad(lower(to_hex((xor(c, 5614165) * 2654435761) & 16777215)), 6, '0') as address_color from n""")
def map_colors(spark, sf):
    return maps.cluster_colors(storms(spark, sf)).select(
        "cluster_id", "num_points", "color", text.hex_color("cluster_id", text.SECOND_SERIES).alias("address_color"))


def _ring_sum(ring):
    """One number that tells rings apart: rounded x, y and x * y of every vertex."""
    r = lambda v, k: F.round(v * k)
    return F.aggregate(ring, F.lit(0.0), lambda s, p: s + r(p[0], 1e4) + 3 * r(p[1], 1e4) + r(p[0], 1e2) * r(p[1], 1e2)).cast("long")


@query("geojson_features", f"""with {STORMS}, {ring_sql('edge', 'cluster_id')} select s.cluster_id, 'Polygon' as kind, s.num_points, min(e.ax) as start_lon, arg_min(e.ay, (e.ax, e.ay)) as start_lat,
 count(*) as vertices, cast(round(sum(round(e.ax * 1e4) + 3 * round(e.ay * 1e4) + round(e.ax * 1e2) * round(e.ay * 1e2))) as bigint) as ring_sum,
 any_value(ring) as wkt_ring from stats s join edge e on e.cluster_id = s.cluster_id join edge_ring r on r.cluster_id = s.cluster_id
 group by s.cluster_id, s.num_points""")
def geojson_features(spark, sf):
    f = storms(spark, sf).select("cluster_id", maps.feature(geo.geojson_polygon(F.col("ring")), ["cluster_id", "num_points"]).alias("f"),
                                 geo.wkt_polygon(F.col("ring")).alias("w"))
    at = lambda path, kind: F.get_json_object("f", path).cast(kind)
    closed = F.from_json(F.get_json_object("f", "$.geometry.coordinates[0]"), "array<array<double>>")
    f = f.withColumn("closed", closed).withColumn("ring", F.slice("closed", 1, F.size("closed") - 1))
    number = lambda p, i: F.split(p, " ")[i].cast("double")
    wkt = F.transform(F.split(F.regexp_extract("w", r"^POLYGON \(\((.*)\)\)$", 1), ", "), lambda p: geo.vertex(number(p, 0), number(p, 1)))
    return f.select("cluster_id", at("$.geometry.type", "string").alias("kind"), at("$.properties.num_points", "long").alias("num_points"),
                    at("$.geometry.coordinates[0][0][0]", "double").alias("start_lon"),
                    at("$.geometry.coordinates[0][0][1]", "double").alias("start_lat"), 
                    F.size("ring").cast("long").alias("vertices"), _ring_sum("ring").alias("ring_sum"), ring_text(wkt).alias("wkt_ring"))


@query("address_point_features", f"""with {ctes('fx_addresses')} select id, cast(json_extract(f, '$.properties.zip') as varchar) as zip, json_extract_string(f, '$.geometry.type') as kind,
 round(lon, 6) as lon, round(lat, 6) as lat
 from (select id, lon, lat, to_json({{'geometry': {{'type': 'Point'}}, 'properties': {{'zip': cast(zip as integer)}}}}) as f from fx_addresses)""")
def address_point_features(spark, sf):
    f = maps.feature(geo.geojson_point("lon", "lat"), ["id", "zip"])
    return fx(spark, sf, "fx_addresses").select("id", f.alias("f")).select(
        "id", F.get_json_object("f", "$.properties.zip").alias("zip"), F.get_json_object("f", "$.geometry.type").alias("kind"),
        *[F.round(F.get_json_object("f", f"$.geometry.coordinates[{i}]").cast("double"), 6).alias(c) for i, c in enumerate(("lon", "lat"))])
