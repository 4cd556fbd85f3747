"""Vendor responses -> property, owner and contact rows; tables -> vendor columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import blank, filled, first_truthy


def read_lookup_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed lookup responses -> one row per property, under column ``p``."""
    ddl = f"results struct<properties:array<struct<{_nested(schemas.PROPERTY)}>>>"
    return spark.read.schema(ddl).json(path).select(F.explode("results.properties").alias("p"))


def read_search_responses(spark: SparkSession, path: str) -> DataFrame:
    ddl = f"results array<struct<{_nested(schemas.SEARCH_RESULT)}>>"
    return spark.read.schema(ddl).json(path).select(F.explode("results").alias("r"))


def parse_properties(df: DataFrame, body: str = "body") -> DataFrame:
    return df.withColumn("p", F.from_json(body, schemas.PROPERTY))


def parse_results(df: DataFrame, body: str = "body") -> DataFrame:
    return df.withColumn("r", F.from_json(body, schemas.SEARCH_RESULT))


def flatten_properties(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The stored property columns; an empty street falls back to the one without unit."""
    p = lambda path: F.col(f"p.{path}")
    return df.select(
        *keep, p("_id").alias("property_id"),
        first_truthy(p("address.street"), p("address.streetNoUnit")).alias("street"),
        p("address.city").alias("city"), p("address.state").alias("state"), p("address.zip").alias("zip"),
        p("address.zipPlus4").alias("zip_plus4"), p("address.latitude").alias("latitude"),
        p("address.longitude").alias("longitude"), p("address.county").alias("county"),
        p("ids.fipsCode").alias("fips_code"),
        p("assessment.totalAssessedValue").cast("long").alias("total_assessed_value"),
        p("assessment.totalMarketValue").cast("long").alias("total_market_value"),
        p("building.yearBuilt").alias("year_built"), p("building.livingAreaSquareFeet").alias("living_area_sqft"),
        p("owner.ownerOccupied").alias("owner_occupied"), p("general.vacant").alias("vacant"),
        p("general.standardizedLandUseCode").alias("standardized_land_use"),
        p("general.propertyTypeDetail").alias("property_type_detail"),
        p("intel.lastSoldDate").try_cast("timestamp_ntz").alias("last_sold_date"),
        p("intel.lastSoldPrice").cast("long").alias("last_sold_price"))


def mailing_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The short form for mail lists: the street without unit comes first here."""
    p = lambda path: F.col(f"p.{path}")
    market, assessed = p("assessment.totalMarketValue"), p("assessment.totalAssessedValue")
    return df.select(
        *keep, first_truthy(p("address.streetNoUnit"), p("address.formattedStreet"), p("address.street")).alias("street"),
        p("address.city").alias("city"), p("address.state").alias("state"), p("address.zip").alias("zip"),
        p("owner.ownerOccupied").alias("owner_occupied"), p("general.vacant").alias("vacant"),
        market.alias("total_market_value"), assessed.alias("total_assessed_value"),
        F.coalesce(market, assessed).alias("value_used"))


def contacts(df: DataFrame) -> DataFrame:
    """One row per distinct email and per phone; both come out of one pass over the parsed record."""
    def one(**known):
        kinds = {"email": "string", "phone": "string", "phone_type": "string", "carrier": "string", "score": "int",
                 "dnc": "boolean", "reachable": "boolean", "last_reported": "timestamp_ntz"}
        return F.struct(*[known.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])

    owner, none = F.col("p.owner"), F.array().cast("array<string>")
    mails = F.array_distinct(F.filter(F.coalesce(owner["emails"], none), lambda e: e.isNotNull() & (e != "")))
    phones = F.transform(owner["phoneNumbers"], lambda ph: one(
        phone=ph["number"], phone_type=ph["type"], carrier=ph["carrier"], score=ph["score"], dnc=ph["dnc"],
        reachable=ph["reachable"], last_reported=ph["lastReportedDate"].try_cast("timestamp_ntz")))
    each = F.transform(mails, lambda e: one(email=e))
    return df.select(F.col("p._id").alias("property_id"), F.inline(F.when(
        owner["phoneNumbers"].isNull(), each).otherwise(F.concat(each, phones))))


def contact_arrays(rows: DataFrame) -> DataFrame:
    """Contacts back to one row per property: emails as a set, phones as a list of structs."""
    phone = F.when(F.col("phone").isNotNull(), F.struct(
        "phone", "phone_type", "carrier", "score", "dnc", "reachable", "last_reported"))
    return rows.groupBy("property_id").agg(F.sort_array(F.collect_set("email")).alias("emails"),
                                           F.sort_array(F.collect_list(phone)).alias("phones"))


def search_properties(df: DataFrame) -> DataFrame:
    r = F.col("r")
    return df.select(r["externalId"].cast("long").alias("address_id"), r["property"]["parcelId"].alias("parcel_id"),
                     r["property"]["sqFt"].alias("sq_ft"), r["property"]["yearBuilt"].alias("year_built"),
                     r["property"]["assessedValue"].alias("assessed_value"), F.to_json(r).alias("metadata"))


def search_owners(df: DataFrame) -> DataFrame:
    o = F.col("o")
    return df.select(F.col("r.externalId").cast("long").alias("address_id"), F.explode("r.owners").alias("o")).select(
        "address_id", o["name"].alias("name"), o["phone"].alias("phone"), o["email"].alias("email"),
        o["mailingAddress"].alias("mailing_address"), F.to_json(o).alias("metadata"))


def vendor_columns(df: DataFrame) -> DataFrame:
    """``address, city, state, zip`` for a vendor file.

    Which column holds the address is decided once for the data set, by one aggregate: ``address`` if any
    value is set, else ``street``, else the first of the other names present.
    """
    have = set(df.columns)
    ask = [c for c in ("address", "street") if c in have]
    counts = df.agg(*[F.count(c).alias(c) for c in ask]).first() if ask else {}
    source = next((c for c in ask if counts[c] > 0), None) or next(
        (c for c in ("street", "address1", "addr1", "line1") if c in have), None)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    zip_ = "zip" if "zip" in have else "postal_code"
    out = df.select(text(source).alias("address"), text("city").alias("city"), text("state").alias("state"),
                    text(zip_).alias("zip"))
    return out.where(~blank("address") & ~blank("city") & ~blank("state"))


def lookup_entry(street="street", city="city", state="state", zip_="zip"):
    """One request of a lookup batch."""
    part = lambda c: F.coalesce(filled(F.col(c).cast("string")), F.lit(""))
    return F.struct(F.struct(part(street).alias("street"), part(city).alias("city"), part(state).alias("state"),
                             part(zip_).alias("zip")).alias("address"))


def lookup_payload(entries="entries"):
    return F.to_json(F.struct(F.col(entries).alias("requests"),
                              F.struct(F.lit(True).alias("skipTrace")).alias("options")))


def search_entry():
    return F.struct(F.concat_ws(" ", "number", "street").alias("line1"), F.col("city"), F.col("state"),
                    F.col("zip").alias("postalCode"), F.col("id").cast("string").alias("externalId"))


def search_payload(entries="entries"):
    return F.to_json(F.struct(F.col(entries).alias("addresses")))


def _nested(ddl: str) -> str:
    """Top-level ``a T, b T`` to struct form ``a:T,b:T``."""
    out, depth = [], 0
    for tok in ddl.split(", "):
        out.append(tok if depth else tok.replace(" ", ":", 1))
        depth += tok.count("<") - tok.count(">")
    return ",".join(out)
