"""Address inputs: GeoJSON features, CSV with many header names, OSM nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo
from ..functions.binding import let
from ..functions.text import blank, compose_address, first_filled
from . import geojson

# Property names tried in order
NUMBER = ("number", "house_number", "house", "addr_num")
STREET = ("street", "street_name", "road", "addr_street")
CITY = ("city", "locality", "town")
REGION = ("region", "state")
POSTCODE = ("postcode", "postal_code", "zip")

# CSV header aliases
HEADERS = {
    "street": ("street_address", "addr", "address1", "address"),
    "city": ("city_name",),
    "state": ("state_code", "region"),
    "zip": ("zipcode", "postal_code", "postcode", "zip_code"),
}


def _address_of(f: Column) -> Column:
    """Address columns of one parsed feature."""
    props, kind, coords = f["properties"], f["geometry"]["type"], f["geometry"]["coordinates"]
    num, street, city, region, zip_ = (first_filled(*[props[n] for n in names])
                                       for names in (NUMBER, STREET, CITY, REGION, POSTCODE))
    parts = F.struct(num.alias("number"), street.alias("street"), city.alias("city"), region.alias("state"), zip_.alias("zip"),
                     _center(kind, coords).alias("at"))
    return let(parts, lambda p: F.struct(
        compose_address(p["number"], p["street"], p["city"], p["state"], p["zip"]).alias("address"),
        *[p[c].alias(c) for c in ("number", "street", "city", "state", "zip")],
        p["at"]["x"].alias("lon"), p["at"]["y"].alias("lat")))


def _center(kind: Column, coords: Column) -> Column:
    """The point itself, or the centroid of any other geometry."""
    point, line, poly = "array<double>", "array<array<double>>", "array<array<array<double>>>"
    parse = lambda t: F.from_json(coords, t)
    return (F.when(kind == "Point", let(parse(point), lambda c: geo.vertex(F.get(c, F.lit(0)), F.get(c, F.lit(1)))))
            .when(kind == "Polygon", geo.rings_centroid(F.array(parse(poly))))
            .when(kind == "MultiPolygon", geo.rings_centroid(parse(f"array<{poly}>")))
            .when(kind == "LineString", geo.lines_centroid(F.array(parse(line))))
            .when(kind == "MultiLineString", geo.lines_centroid(parse(poly)))
            .when(kind == "MultiPoint", let(parse(line), lambda ps: geo.vertex(
                F.aggregate(ps, F.lit(0.0), lambda s, p: s + p[0]) / F.size(ps),
                F.aggregate(ps, F.lit(0.0), lambda s, p: s + p[1]) / F.size(ps)))))


def address_rows(features: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature text -> address, number, street, city, state, zip, lon, lat, for every feature; parsed once per row."""
    parsed = let(F.from_json(body, schemas.FEATURE, {"mode": "PERMISSIVE"}), _address_of)
    # inline over a one-element array: a generator is a barrier to merging projects
    return features.select(*keep, F.inline(F.array(parsed)))


def usable() -> Column:
    """Has an address and a place."""
    return F.col("address").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()


def normalize_features(features: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Features that give an address: see ``address_rows``.

    Other geometries than points become their centroid. Features without number and street, without
    geometry, or that do not parse are dropped.
    """
    return address_rows(features, body, keep).where(usable())


def read_addresses(spark: SparkSession, folders: str | list[str], names: str = geojson.NAMES) -> DataFrame:
    """Addresses of all GeoJSON documents under ``folders``, with ``file_path``."""
    return normalize_features(geojson.read_geojson(spark, folders, names), keep=("file_path",))


def new_files(files: DataFrame, log: DataFrame, path: str = "file_path") -> DataFrame:
    """Files the import log does not list."""
    return files.join(log.select(path).distinct(), path, "left_anti")


def import_entries(files: DataFrame, as_of: Column, path: str = "file_path") -> DataFrame:
    """Log rows for files just handled, also those that failed or held nothing."""
    return files.select(path).distinct().withColumn("imported_at", as_of.cast("timestamp_ntz"))


def canonical_headers(df: DataFrame, required: tuple[str, ...] = ("street", "city", "state", "zip")) -> DataFrame:
    """One column per canonical name: the name itself first, then its aliases as listed."""
    have = {}
    for c in df.columns:
        have.setdefault(c.strip().lower(), c)
    out, used = [], set()
    for name, aliases in HEADERS.items():
        found = [have[n] for n in (name, *aliases) if n in have]
        if found:
            used.update(found)
            out.append(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in found]).alias(name))
    missing = [n for n in required if n not in {c for c, a in HEADERS.items() if any(k in have for k in (c, *a))}]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in used], *out)


def complete(df: DataFrame, parts: tuple[str, ...] = ("street", "city", "state", "zip")) -> DataFrame:
    """Rows with every part present and not blank."""
    keep = F.lit(True)
    for p in parts:
        keep = keep & ~blank(F.col(p).cast("string"))
    return df.where(keep)


def read_lonlat_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose columns longitude and latitude are the geometry."""
    return (spark.read.option("header", True).option("enforceSchema", False).schema(schemas.ADDRESS_LONLAT).csv(path)
            .withColumnsRenamed({"longitude": "lon", "latitude": "lat"}))


def osm_addresses(nodes: DataFrame) -> DataFrame:
    """Nodes with a house number -> ``"num street, city, state pc"`` without outer commas and blanks."""
    tag = lambda k: F.coalesce(F.col("tags")[f"addr:{k}"], F.lit(""))
    text = F.concat(tag("housenumber"), F.lit(" "), tag("street"), F.lit(", "), tag("city"), F.lit(", "),
                    tag("state"), F.lit(" "), tag("postcode"))
    return (nodes.where(F.map_contains_key("tags", "addr:housenumber"))
            .select("id", F.btrim(text, F.lit(", ")).alias("address"), "lat", "lon"))


def read_polygons(spark: SparkSession, path: str | list[str], names: str = "*") -> DataFrame:
    """Polygon and MultiPolygon features of GeoJSON files: one row per part, outer ring, ``holes`` and envelope.

    ``polygon_id`` is a hash of the file's path and the feature's place in it, so it is the same in every read and differs
    between files; parts of one feature share it and ``part`` numbers them from 0. ``geo.in_part`` leaves holes out.
    """
    feats = geojson.read_geojson(spark, path, names).select(
        F.xxhash64("file_path", "position").alias("polygon_id"), F.from_json("body", GEOMETRY_FEATURE).alias("f"))
    return (feats.select("polygon_id", F.col("f.properties").alias("properties"),
                         F.posexplode(polygon_parts(F.col("f.geometry"))).alias("part", "p"))
            .select("polygon_id", "properties", "part", "p.ring", "p.holes").withColumns(geo.bounds(F.col("ring"))))


#: A feature whose coordinates are kept as text, as their depth depends on the geometry's type.
GEOMETRY_FEATURE = "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"


def polygon_parts(geometry: Column) -> Column:
    """``array<struct<ring, holes>>`` of a Polygon or MultiPolygon; empty for any other geometry."""
    one = "array<array<array<double>>>"
    polygons = F.when(geometry["type"] == "Polygon", F.array(F.from_json(geometry["coordinates"], one))).when(
        geometry["type"] == "MultiPolygon", F.from_json(geometry["coordinates"], f"array<{one}>"))
    ring = lambda pts: F.transform(pts, lambda p: geo.vertex(p[0], p[1]))
    return F.transform(F.filter(F.coalesce(polygons, F.array()), lambda p: F.size(F.get(p, F.lit(0))) > 0), lambda p: F.struct(
        ring(p[0]).alias("ring"), F.transform(F.slice(p, 2, F.size(p)), ring).alias("holes")))
