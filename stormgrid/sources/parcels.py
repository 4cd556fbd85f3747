"""Parcel features -> parcels and owners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import number_or_null, title_case
from . import geojson
from .addresses import GEOMETRY_FEATURE, polygon_parts

# Source names tried in order, in any case
PARCEL_ID = ("PARCEL_ID", "PARID", "PARCELID")
OWNER = ("OWNER_NAME", "OWNER1", "OWNERNM")
MAILING = ("MAILING_ADDR", "MAILING_ADDRESS", "MAIL_ADDR")
ASSESSED = ("ASSESSED_VALUE", "TOT_ASSD_VAL", "ASSESSED")

# County name and source tag written with every row
COUNTY, SOURCE = "Jefferson", "jefferson_arcgis"


def read_parcel_pages(spark: SparkSession, path: str | list[str], box: str | None = None, names: str = "*") -> DataFrame:
    """Landed GeoJSON pages: one row per feature, attributes as a map, all ``parts`` with their holes, the first part's
    outer ring, and the envelope of all parts. With ``box`` only features of which a part meets it, exactly."""
    feats = geojson.read_geojson(spark, path, names).select(F.from_json("body", GEOMETRY_FEATURE).alias("f"))
    df = (feats.select(F.col("f.properties").alias("attributes"), polygon_parts(F.col("f.geometry")).alias("parts"))
          .withColumn("ring", F.get("parts", F.lit(0))["ring"])
          .withColumns(geo.bounds(F.flatten("parts.ring"))))
    if not box:
        return df
    edges = geo.parse_box(box)
    near = df.where(geo.boxes_meet("xmin", "ymin", "xmax", "ymax", edges))
    return near.where(F.exists("parts", lambda p: geo.part_meets_box(p["ring"], p["holes"], edges)))


def attributes_to_columns(df: DataFrame, names=PARCEL_ID + OWNER + MAILING + ASSESSED) -> DataFrame:
    """Known attribute names as columns, where any row has them; one aggregate over the key sets."""
    seen = df.select(F.explode(F.map_keys("attributes")).alias("k")).where(F.upper("k").isin(list(names))).distinct()
    keys = [r[0] for r in seen.collect()]     # at most the case variants of the fixed names
    return df.select("*", *[F.col("attributes")[k].alias(k) for k in keys])


def _first_column(df: DataFrame, names) -> F.Column | None:
    have = {c.upper(): c for c in df.columns}
    return next((F.col(have[n]) for n in names if n in have), None)


def normalize_parcels(df: DataFrame, county: str = COUNTY, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical parcel columns and a JSON snapshot of the source row.

    The source column is chosen once for the data set, by name. Rows without a usable key are dropped:
    null, blank, or the text of a missing value.
    """
    pick = lambda names: (c if (c := _first_column(df, names)) is not None else F.lit(None)).cast("string")
    raw = F.to_json(F.struct(*df.columns))
    out = df.select(*keep, F.trim(pick(PARCEL_ID)).alias("parcel_id"), F.lit(county).alias("county"),
                    F.trim(title_case(pick(OWNER))).alias("owner_name"), F.trim(pick(MAILING)).alias("mailing_address"),
                    number_or_null(pick(ASSESSED)).alias("assessed_value"),
                    *[c for c in ("ring",) if c in df.columns], raw.alias("raw"))
    return out.where(F.col("parcel_id").isNotNull() & ~F.col("parcel_id").isin("", "nan", "None"))


def owners_of(parcels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    meta = F.to_json(F.struct(F.lit(SOURCE).alias("source"), F.col("owner_name").alias("raw_owner")))
    return (parcels.where("owner_name is not null and owner_name <> ''")
            .select(*keep, "parcel_id", F.col("owner_name").alias("name"), "mailing_address", meta.alias("metadata")))


