"""Text expressions used on names, addresses and exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address patterns, matched anywhere and in any case
PO_BOX = r"(?i)PO\s*BOX"
MULTI_UNIT = r"(?i)(APT|UNIT|STE|SUITE|#\s*[0-9]+)"


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def filled(v) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(_c(v)), F.lit(""))


def first_filled(*cols) -> Column:
    """First candidate that holds more than blanks, trimmed."""
    return F.coalesce(*[filled(c) for c in cols])


def first_truthy(*cols) -> Column:
    """First candidate that is neither null nor the empty text, as it is."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def blank(v) -> Column:
    return F.coalesce(F.trim(_c(v)) == "", F.lit(True))


def title_case(v) -> Column:
    """A capital after every character that is not a letter, lower case elsewhere."""
    runs = F.regexp_extract_all(F.lower(_c(v)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def mask_middle(v, left: int = 4, right: int = 4) -> Column:
    """Keep the ends; text not longer than both ends together turns into dots."""
    s = _c(v)
    return F.when(F.length(s) <= left + right, F.repeat(F.lit("…"), F.length(s))) \
            .otherwise(F.concat(F.left(s, F.lit(left)), F.lit("…"), F.right(s, F.lit(right))))


def hex_color(n, flip: int = 0) -> Column:
    """Stable colour of an id; ``flip`` gives a second, related series."""
    mixed = (_c(n).cast("long").bitwiseXOR(F.lit(flip).cast("long")) * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFF))
    return F.concat(F.lit("#"), F.lpad(F.lower(F.hex(mixed)), 6, "0"))


SECOND_SERIES = 0x55AA55    # fixed value: flips ids of address clusters


def compose_address(num: Column, street: Column, city: Column, region: Column, zip_: Column) -> Column:
    """``"num street, city, region, zip"`` of the parts present; null without number and street."""
    base = F.concat_ws(" ", num, street)
    return F.when(num.isNotNull() | street.isNotNull(), F.concat_ws(", ", base, city, region, zip_))


def not_po_box(v) -> Column:
    return ~_c(v).rlike(PO_BOX)


def not_multi_unit(v) -> Column:
    return ~_c(v).rlike(MULTI_UNIT)


def number_or_null(v) -> Column:
    return _c(v).try_cast("double")


def flat_text(df) -> list[Column]:
    """Columns ready for CSV: arrays, maps and structs become JSON text."""
    out = []
    for f in df.schema.fields:
        nested = f.dataType.typeName() in ("array", "map", "struct")
        out.append(F.to_json(F.col(f.name)).alias(f.name) if nested else F.col(f.name))
    return out


def is_true(v) -> Column:
    return F.coalesce(_c(v), F.lit(False))
