import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from stormgrid.functions import payload, text, timing
from stormgrid.operators import qualify, rows
from stormgrid.plans import addresses as plan
from stormgrid.plans import hail
from stormgrid.sources import addresses, geojson, parcels, products, vendor


def values(spark, sql, cols):
    return spark.sql(f"select * from values {sql} as t({cols})")


def test_products_by_state_and_window(spark, tmp_path):
    root = str(tmp_path / "p")
    rows_ = [(i, f"2024-01-{d:02d} 00:00:00", 1, 1.0, float(i), 0.0, "nx3hail", s, c) for i, d, s, c in
             [(1, 3, "GA", "2024-01-01"), (1, 3, "KY", "2024-01-01"), (2, 20, "GA", "2024-01-01"), (2, 20, "GA", "2024-01-15"), (3, 25, "GA", "2024-01-15")]]
    df = spark.createDataFrame(rows_, "id long, valid string, sevprob int, maxsize double, lon double, lat double, dataset string, state string, chunk_start string")
    df.withColumn("valid", F.col("valid").cast("timestamp_ntz")).write.partitionBy("dataset", "state", "chunk_start").parquet(root)
    read = lambda **k: sorted((r.state, r.id) for r in products.read_product(spark, root, "nx3hail", **k).collect())
    assert read() == [("GA", 1), ("GA", 2), ("GA", 3), ("KY", 1)]       # one row per id and state
    assert read(states=["GA"], end="2024-01-22") == [("GA", 1), ("GA", 2)]
    assert read(box="1.5,-1,9,1") == [("GA", 2), ("GA", 3)]
    plan_ = products.read_product(spark, root, "nx3hail", states=["GA"])._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan_ and "state" in plan_
    with pytest.raises(ValueError):
        products.read_product(spark, root, "other")


def test_storm_details_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("BEGIN_DATE_TIME,EPISODE_ID,X,EVENT_ID,BEGIN_LAT,BEGIN_LON\n2024-01-01 10:00:00,1,q,7,38.0,-85.0\n,1,q,7,,-85.0\n2024-01-01 11:00:00,1,q,7,38.5,-85.5\n")
    d = products.read_storm_details(spark, str(tmp_path))
    b = hail.storm_event_boundaries(d, ["source_file", "BEGIN_DATE_TIME"]).first()
    assert (b.id, b.num_points, b.hull_kind, b.first_lat, b.begin_time.hour) == (7, 2, "line", 38.0, 10)


def test_landing_and_latest_files(spark, tmp_path):
    from stormgrid.sinks import tables
    h = values(spark, "(1L, timestamp_ntz'2024-01-03 00:00:00', 1, 1D, 0D, 0D, 'GA'), (2L, timestamp_ntz'2024-02-03 00:00:00', 1, 1D, 0D, 0D, 'KY')", "id, valid, sevprob, maxsize, lon, lat, state")
    root = str(tmp_path / "p")
    for _ in range(2):
        tables.land_product(h, root, "nx3hail", "2024-01-01", "2024-03-01")
    assert products.read_product(spark, root, "nx3hail").count() == spark.read.parquet(root).count() == 2
    (tmp_path / "d").mkdir()
    for day, lat in (("20240101", 1), ("20240301", 2)):
        with gzip.open(tmp_path / "d" / f"StormEvents_details-ftp_v1.0_d2024_c{day}.csv.gz", "wt") as f:
            f.write(f"EPISODE_ID,EVENT_ID,BEGIN_DATE_TIME,BEGIN_LAT,BEGIN_LON\n1,2,2024-01-01 00:00:00,{lat},3\n")
    assert [r.BEGIN_LAT for r in products.read_latest_details(spark, str(tmp_path / "d")).collect()] == [2.0]


def test_latest_release(spark):
    name = "x/StormEvents_details-ftp_v1.0_d{}_c{}.csv.gz"
    f = spark.createDataFrame([(name.format(2024, 20240105),), (name.format(2024, 20240301),), (name.format(2023, 20230101),), ("junk",)], "path string")
    assert {(r.year, r.release) for r in products.latest_releases(f).collect()} == {("2024", "20240301"), ("2023", "20230101")}


def test_geojson_collections_and_shapes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    geoms = [{"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]},
             {"type": "LineString", "coordinates": [[0, 0], [2, 2]]}, None, {"type": "Point", "coordinates": []}]
    feats = [{"type": "Feature", "properties": {"house_number": 7, "road": "Elm", "zip": " 1 "}, "geometry": g} for g in geoms]
    square = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[2, 0], [4, 0], [4, 4], [2, 4], [2, 0]]]       # right half is a hole
    feats.append({"type": "Feature", "properties": {"road": "Hole"}, "geometry": {"type": "MultiPolygon", "coordinates": [square]}})
    feats.append({"type": "Feature", "properties": {"city": "x"}, "geometry": geoms[0]})
    (tmp_path / "sub" / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=1))
    (tmp_path / "bad.json").write_text("{ nope")
    raw = geojson.read_geojson(spark, str(tmp_path))
    got = sorted((r.lon, r.lat, r.address) for r in addresses.normalize_features(raw).collect())
    assert got == [(1.0, 1.0, "7 Elm, 1"), (1.0, 1.0, "7 Elm, 1"), (1.0, 2.0, "7 Elm, 1"), (1.0, 2.0, "Hole")]
    files = geojson.list_files(spark, str(tmp_path))
    log = addresses.import_entries(files, F.lit("2024-01-01"))
    assert log.count() == 2 and addresses.new_files(files, log).count() == 0      # unreadable files are logged too


def test_headers_and_required_parts(spark):
    df = values(spark, "('1 A', null, 'C', 'KY', '1'), (null, '2 B', 'C', ' ', '2')", "`Address`, street, City_Name, region, zip_code")
    out = addresses.canonical_headers(df)
    assert [(r.street, r.state, r.zip) for r in out.collect()] == [("1 A", "KY", "1"), ("2 B", " ", "2")]
    assert addresses.complete(out).count() == 1
    with pytest.raises(ValueError):
        addresses.canonical_headers(df.drop("zip_code"))


def test_lonlat_csv_in_general_polygon(spark, tmp_path):
    (tmp_path / "a.csv").write_text("longitude,latitude,number,street,city,region,postcode\n0.5,0.5,1,S,C,R,1\n1.5,1.5,2,S,C,R,1\n")
    (tmp_path / "s.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": "x"}, "geometry": {
        "type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1], [1, 1], [1, 2], [0, 2], [0, 0]]]}}]}))
    pts = addresses.read_lonlat_csv(spark, str(tmp_path / "a.csv"))
    storm = addresses.read_polygons(spark, str(tmp_path / "s.geojson"))
    assert [r.number for r in plan.in_any_storm(pts, storm, "number", convex=False).collect()] == ["1"]


def test_parcel_pages(spark, tmp_path):
    ring = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    feats = [{"type": "Feature", "properties": {"parid": " 9 ", "OwnerNm": "o'brien", "ASSESSED": "n/a"}, "geometry": {"type": "Polygon", "coordinates": ring}},
             {"type": "Feature", "properties": {"parid": "nan"}, "geometry": {"type": "Polygon", "coordinates": ring}}]
    (tmp_path / "p.json").write_text(json.dumps({"features": feats}))
    raw = parcels.read_parcel_pages(spark, str(tmp_path), "0.5,0,3,3")
    got = parcels.normalize_parcels(parcels.attributes_to_columns(raw)).collect()
    assert len(got) == 1 and (got[0].parcel_id, got[0].owner_name, got[0].assessed_value) == ("9", "O'Brien", None)
    assert parcels.read_parcel_pages(spark, str(tmp_path), "5,5,6,6").count() == 0
    assert parcels.owners_of(parcels.normalize_parcels(parcels.attributes_to_columns(raw))).first().name == "O'Brien"


def test_vendor_responses(spark, tmp_path):
    prop = {"_id": "P1", "address": {"street": "", "streetNoUnit": "1 A"}, "assessment": {"totalAssessedValue": 5}, "intel": {"lastSoldDate": "2020-01-02T00:00:00"},
            "owner": {"emails": ["a@x", "a@x", ""], "phoneNumbers": [{"number": "5", "dnc": True}]}}
    (tmp_path / "r.json").write_text(json.dumps({"results": {"properties": [prop]}}) + "\n" + json.dumps({"results": {}}) + "\n")
    p = vendor.read_lookup_responses(spark, str(tmp_path / "r.json"))
    flat = vendor.flatten_properties(p).first()
    assert (flat.property_id, flat.street, flat.total_assessed_value, flat.last_sold_date.year) == ("P1", "1 A", 5, 2020)
    c = vendor.contacts(p)
    assert sorted((r.email or "", r.phone or "", r.dnc) for r in c.collect()) == [("", "5", True), ("a@x", "", None)]
    arr = vendor.contact_arrays(c).first()
    assert arr.emails == ["a@x"] and arr.phones[0].phone == "5"
    (tmp_path / "s.json").write_text(json.dumps({"results": [{"externalId": "4", "property": {"sqFt": 3}, "owners": [{"name": "N"}]}, {"externalId": "5", "property": {}}]}))
    s = vendor.read_search_responses(spark, str(tmp_path / "s.json"))
    assert sorted(r.address_id for r in vendor.search_properties(s).collect()) == [4, 5]
    assert [(r.address_id, r.name) for r in vendor.search_owners(s).collect()] == [(4, "N")]


def test_vendor_columns_choose_once(spark):
    one = values(spark, "(null, '1 A', 'C', 'KY', '9')", "address, street, city, state, postal_code").withColumn("address", F.lit(None).cast("string"))
    assert [tuple(r) for r in vendor.vendor_columns(one).collect()] == [("1 A", "C", "KY", "9")]
    two = values(spark, "('5 B', '1 A', 'C', 'KY', '9'), (null, '1 A', 'C', 'KY', '9')", "address, street, city, state, zip")
    assert vendor.vendor_columns(two).count() == 1
    assert vendor.vendor_columns(values(spark, "('7 L', 'C', 'KY')", "line1, city, state")).first().address == "7 L"


def test_rules_differ_on_nulls(spark):
    d = spark.createDataFrame([(1, True, False, 5), (2, True, None, 5), (3, True, False, None), (4, None, False, 5), (5, True, False, 0), (6, True, True, 5), (7, True, False, 99)],
                              "property_id int, owner_occupied boolean, vacant boolean, total_assessed_value long").withColumn("value_used", F.col("total_assessed_value"))
    ids = lambda c: {r.property_id for r in d.where(c).collect()}
    assert ids(qualify.strict(10)) == {1, 5}
    assert ids(qualify.lenient(10)) == {1, 2, 3, 5}
    assert ids(qualify.mixed(10)) == {1, 2}


def test_text_rules(spark):
    df = spark.createDataFrame([("o'BRIEN mc-donald 3rd", "CAPTAIN CT", "po  box 1"), ("", "9 STEVENS RD", "PO BOX"), ("ABCDEFGHI", "1 Elm # 3", "1 Elm")], "a string, b string, c string")
    r = df.select(text.title_case("a").alias("t"), text.mask_middle("a").alias("m"), text.not_multi_unit("b").alias("u"), text.not_po_box("c").alias("p")).collect()
    assert [x.t for x in r] == ["O'Brien Mc-Donald 3Rd", "", "Abcdefghi"]
    assert r[2].m == "ABCD…FGHI" and r[1].m == ""
    assert [x.u for x in r] == [False, False, False] and [x.p for x in r] == [False, False, True]   # substrings match on purpose


@pytest.mark.parametrize("body,job,status,event", [
    ('{"jobId": 5, "status": "a", "event": "e"}', "5", "a", "e"),
    ('{"jobId": {"x": 1}, "id": "7"}', "7", None, None),
    ('{"id": "", "data": {"job_id": 12345678901234567890}}', "12345678901234567890", None, None),
    ('{"id": "", "data": {}}', "", None, None),
    ('{"id": 1.5, "data": {"status": "z"}}', None, "z", None),
    ('{"status": {"message": "m"}, "data": {"status": "no"}, "event": 3, "action": "go"}', None, "m", "go"),
    ('{"status": {}, "data": {"status": "no"}}', None, None, None),
    ("nope", None, None, None), ("[1]", None, None, None),
])
def test_event_fields(spark, body, job, status, event):
    v = payload.parse("b")
    r = spark.createDataFrame([(body,)], "b string").select(payload.job_id(v).alias("j"), payload.status(v).alias("s"), payload.event_type(v).alias("e")).first()
    assert tuple(r) == (job, status, event)


def test_submit_ids(spark):
    df = spark.createDataFrame([('{"data": {"jobId": 1}, "status": {"id": "s"}}',), ('{"status": "ok", "job_id": 4}',), ('{"jobId": 1, "id": 2}',)], "b string")
    v = payload.parse("b")
    assert [r[0] for r in df.select(payload.submit_job_id(v)).collect()] == ["s", "4", "1"]
    assert [r[0] for r in df.select(payload.driver_job_id(v)).collect()] == ["1", "4", "2"]


def test_times_and_chunks(spark):
    r = spark.sql("select timestamp_ntz'1970-01-01 00:00:00' e, timestamp_ntz'2024-01-01 00:00:00' s, 'bad' b").select(
        timing.storm_time("s", "e").alias("t"), timing.utc_or_null("b").alias("b"), timing.label("s").alias("l")).first()
    assert r.t.year == 2024 and r.b is None and r.l == "01-01 00:00"
    c = timing.date_chunks(spark, "2024-01-01", "2024-03-05", 30).collect()
    assert [(str(x.chunk_start), str(x.chunk_end)) for x in c] == [("2024-01-01", "2024-01-31"), ("2024-01-31", "2024-03-01"), ("2024-03-01", "2024-03-05")]
    assert timing.date_chunks(spark, "2024-01-01", "2024-01-01", 30).count() == 0
    d = spark.sql("select explode(array(timestamp_ntz'2023-12-31 23:59:59', timestamp_ntz'2024-01-30 23:00:00', timestamp_ntz'2024-01-31 00:00:00', timestamp_ntz'2024-03-05 00:00:00')) d")
    assert [(x.chunk, str(x.chunk_start)) for x in timing.in_chunks(d, "d", "2024-01-01", "2024-03-05", 30).collect()] == [(0, "2024-01-01"), (1, "2024-01-31")]


def test_time_columns(spark):
    assert hail.time_columns(spark.sql("select 1 END_TIME, 2 Begin_Time, 3 valid")) == ("Begin_Time", "END_TIME")
    assert hail.time_columns(spark.sql("select 1 valid")) == ("valid", None)
    assert hail.time_columns(spark.sql("select 1 x")) == (None, None)


def test_paths_names_and_views(spark):
    from stormgrid.functions import geo
    from stormgrid.sources import tables
    v = payload.parse("b")
    r = spark.createDataFrame([('{"a": {"b": 3}}',)], "b string").select(
        payload.at_path(v, "$.a.b", "int").alias("x"), payload.at_path(v, "$.a.z.q", default="none").alias("y")).first()
    assert tuple(r) == (3, "none")
    ring = geo.literal_ring([(0, 1), (2, 1), (2, 3), (0, 1)])
    assert spark.range(1).select(geo.poly_filter(ring)).first()[0] == 'poly:"1.0 0.0 1.0 2.0 3.0 2.0 1.0 0.0"'
    assert spark.range(1).select(geo.wkt_polygon(ring)).first()[0] == "POLYGON ((0.0 1.0, 2.0 1.0, 2.0 3.0, 0.0 1.0))"
    assert geo.parse_center("-85.7585, 38.2527") == (-85.7585, 38.2527)
    with pytest.raises(ValueError):
        geo.parse_center("x")
    assert tables.alias_view(spark, spark.range(3), "newest").count() == spark.table("newest").count() == 3


def test_first_rows_ignore_order_of_arrival(spark):
    df = values(spark, "('A', '1', 5), ('a', '1', 2), (null, '1', 9), ('A', null, 1)", "address, zip, id")
    for n in (1, 4):
        assert sorted(r.id for r in plan.distinct_addresses(df.repartition(n)).collect()) == [1, 2, 9]
    w = rows.union_windows([df.where("id > 2"), df.where("id < 6")], ["id"])
    assert w.count() == 4


def test_storm_times_as_the_files_write_them(spark, tmp_path):
    (tmp_path / "d.csv").write_text("EPISODE_ID,EVENT_ID,BEGIN_DATE_TIME,BEGIN_LAT,BEGIN_LON\n1,1,28-APR-24 13:45:00,1,2\n"
                                    "1,2,2024-04-28 13:45:00,1,2\n1,3,soon,1,2\n")
    got = {r.EVENT_ID: r.BEGIN_DATE_TIME for r in products.read_storm_details(spark, str(tmp_path)).collect()}
    assert str(got[1]) == str(got[2]) == "2024-04-28 13:45:00" and got[3] is None


def test_multipolygons_and_holes(spark, tmp_path):
    import json

    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    kinds = [("Polygon", [square(0, 0, 4), square(1, 1, 2)]), ("MultiPolygon", [[square(10, 0, 1)], [square(20, 0, 1)]]),
             ("Point", [1, 1])]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"PARID": str(i)}, "geometry": {"type": k, "coordinates": c}}
        for i, (k, c) in enumerate(kinds)]}
    (tmp_path / "p.geojson").write_text(json.dumps(doc))
    storms = addresses.read_polygons(spark, str(tmp_path))
    of: dict = {}
    for r in storms.sort("polygon_id", "part").collect():
        of.setdefault(r.polygon_id, []).append((r.part, len(r.holes)))
    assert sorted(of.values()) == [[(0, 0), (1, 0)], [(0, 1)]]
    (tmp_path / "q.geojson").write_text(json.dumps(doc))
    assert addresses.read_polygons(spark, str(tmp_path)).select("polygon_id").distinct().count() == 4      # two files, two features each
    (tmp_path / "q.geojson").unlink()
    points = spark.createDataFrame([(1, .5, .5), (2, 2., 2.), (3, 1., 2.), (4, 10.5, .5), (5, 20.5, .5), (6, 15., .5)],
                                   "id long, lon double, lat double")
    got = plan.in_storms(points, storms, key="polygon_id", convex=False)
    name = {r.polygon_id: r.properties["PARID"] for r in storms.collect()}
    assert sorted((r.id, name[r.polygon_id]) for r in got.collect()) == [(1, "0"), (4, "1"), (5, "1")]
    assert sorted(r.id for r in plan.in_any_storm(points, storms, convex=False).collect()) == [1, 4, 5]
    parcels_ = parcels.read_parcel_pages(spark, str(tmp_path))
    assert {r.attributes["PARID"]: (len(r.parts), r.xmin, r.xmax) for r in parcels_.collect()} == {
        "0": (1, 0.0, 4.0), "1": (2, 10.0, 21.0), "2": (0, None, None)}
    boxes = {"19.5,-1,22,2": "1", "1.5,1.5,2.5,2.5": None, "0.2,0.2,0.4,0.4": "0", "-9,-9,9,9": "0", "12,0,15,1": None,
             "0.5,1.5,1.5,2.5": "0", "-1,3.9,0,5": "0"}     # the second lies in a hole, the fifth between two parts
    for box, want in boxes.items():
        got = [r.attributes["PARID"] for r in parcels.read_parcel_pages(spark, str(tmp_path), box).collect()]
        assert got == ([want] if want else []), box


def test_storms_numbered_per_state(spark):
    ring = lambda x: [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)]
    storms = spark.createDataFrame([(0, s, [{"x": a, "y": b} for a, b in ring(x)]) for s, x in (("KY", 0.0), ("GA", 50.0))],
                                   "cluster_id int, state string, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(i, x + .5, .5 + i * 1e-5) for i in range(10) for x in (0.0, 50.0)],
                                   "id long, lon double, lat double")
    labelled = plan.label_addresses(points, storms, radius=.1, eps=.001, min_samples=5, keys=("cluster_id", "state"))
    clusters = plan.address_clusters(labelled, ("cluster_id", "state")).collect()
    assert sorted((r.hail_cluster_id, r.hail_state, r.addr_cluster_id, r.num_addresses) for r in clusters) == [
        (0, "GA", 0, 10), (0, "KY", 0, 10)]


def test_chunks_prune_from_both_ends(spark, tmp_path):
    root = str(tmp_path / "p")
    spark.createDataFrame([(1, "nx3hail", "GA", "2024-01-01"), (2, "nx3hail", "GA", "2024-06-01")],
                          "id long, dataset string, state string, chunk_start string").selectExpr(
        "id", "cast(chunk_start as timestamp_ntz) as valid", "1 as sevprob", "1D as maxsize", "0D as lon", "0D as lat", "dataset",
        "state", "cast(chunk_start as date) as chunk_start").write.partitionBy("dataset", "state", "chunk_start").parquet(root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    got = products.read_product(spark, root, "nx3hail", start="2024-05-20", end="2024-07-01", overlaps=False)
    plan_ = got._jdf.queryExecution().toString()
    assert [r.id for r in got.collect()] == [2]
    assert re.search(r"PartitionFilters: \[[^\]]*\(chunk_start#\d+ > ", plan_)
    assert "Exchange" not in plan_
