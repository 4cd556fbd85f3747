"""Lead qualification; three rules that differ in how they read missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import is_true, mask_middle
from ..sources.vendor import contact_arrays
from .rows import top


def strict(cap: float, occupied="owner_occupied", vacant="vacant", value="value_used") -> Column:
    """Anything missing disqualifies."""
    return F.col(occupied) & ~F.col(vacant) & (F.col(value) <= cap)


def lenient(cap: float, occupied="owner_occupied", vacant="vacant", value="total_assessed_value") -> Column:
    """Unknown vacancy is not vacant, an unknown value is 0."""
    return F.col(occupied) & ~is_true(vacant) & (F.coalesce(F.col(value), F.lit(0)) <= cap)


def mixed(cap: float, occupied="owner_occupied", vacant="vacant", value="total_assessed_value") -> Column:
    """Unknown occupancy disqualifies, and so does a value that is missing or under 1."""
    return is_true(occupied) & ~is_true(vacant) & F.coalesce(F.col(value), F.lit(0)).between(1, cap)


def value_used(market="total_market_value", assessed="total_assessed_value") -> Column:
    return F.coalesce(F.col(market).cast("double"), F.col(assessed).cast("double"))


def by_value(value: str, *ties: str) -> list[Column]:
    return [F.desc_nulls_last(value), *[F.asc(t) for t in ties]]


def leads_strict(props: DataFrame, cap: float, n: int, ties: tuple[str, ...]) -> DataFrame:
    valued = props.withColumn("value_used", value_used())
    return top(valued.where(strict(cap)), n, *by_value("value_used", *ties))


def leads_lenient(props: DataFrame, cap: float, n: int, state: str | None = None, state_col: str = "state") -> DataFrame:
    if state:
        props = props.where(F.col(state_col) == state)
    return top(props.where(lenient(cap)), n, *by_value("total_assessed_value", "property_id"))


def leads_mixed(props: DataFrame, cap: float, n: int) -> DataFrame:
    return top(props.where(mixed(cap)), n, *by_value("total_assessed_value", "property_id"))


def within_radius(df: DataFrame, lon: float, lat: float, metres: float, x="longitude", y="latitude") -> DataFrame:
    """Rows within a geodesic circle; the envelope goes to the scan, the exact test runs on what is left."""
    box = geo.geodesic_box(lon, lat, metres)
    return df.where(geo.in_box(x, y, *box)).where(geo.geodesic(x, y, lon, lat) <= metres)


def leads_in_radius(props: DataFrame, center: tuple[float, float], radius_km: float, cap: float, n: int) -> DataFrame:
    near = within_radius(props.where(lenient(cap)), *center, radius_km * 1000.0)
    return top(near, n, *by_value("total_assessed_value", "property_id"))


def with_contacts(leads: DataFrame, contacts: DataFrame, mask: bool = True) -> DataFrame:
    """Leads with their owners' ``emails`` and ``phones`` (``dnc`` kept), null where there are none.

    Contacts are cut to the leads before they are gathered; ``mask`` hides the middle of numbers.
    """
    wanted = contacts.join(leads.select("property_id").distinct(), "property_id", "left_semi")
    if mask:
        wanted = wanted.withColumn("phone", mask_middle("phone"))
    return leads.join(contact_arrays(wanted), "property_id", "left")
