"""Field extraction from loosely structured JSON bodies.

The JSON type of a value matters (a number is an id, an object is not), so bodies are read as variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

JOB_KEYS = ("jobId", "job_id", "id")


def parse(body) -> Column:
    return F.try_parse_json(F.col(body) if isinstance(body, str) else body)


def _type(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _scalar(v: Column, path: str) -> Column:
    """Text of a text or whole-number value, else null."""
    return let(_type(v, path), lambda t: F.when(
        (t == "STRING") | (t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), _text(v, path)))


def _string(v: Column, path: str) -> Column:
    return F.when(_type(v, path) == "STRING", _text(v, path))


def _is_object(v: Column, path: str) -> Column:
    return F.coalesce(_type(v, path).startswith("OBJECT"), F.lit(False))


def _first(v: Column, prefix: str, keys) -> Column:
    return F.coalesce(*[_scalar(v, f"{prefix}.{k}") for k in keys])


def job_id(v: Column, keys=JOB_KEYS) -> Column:
    """Id at the top, or inside ``data`` when the top has none or an empty one."""
    return let(_first(v, "$", keys), lambda top: F.coalesce(
        F.nullif(top, F.lit("")), _first(v, "$.data", keys), top))


def driver_job_id(v: Column) -> Column:
    """The driver's order of names; empty text when there is none."""
    return F.coalesce(job_id(v, ("id", "jobId", "job_id")), F.lit(""))


def submit_job_id(v: Column) -> Column:
    """Id in a submit response: the last container that has one wins, then the top level."""
    keys = ("jobId", "id", "job_id")
    inside = [F.when(_is_object(v, f"$.{c}"), F.coalesce(*[_text(v, f"$.{c}.{k}") for k in keys]))
              for c in ("status", "job", "result", "data")]
    return F.coalesce(F.nullif(F.coalesce(*inside), F.lit("")), *[_text(v, f"$.{k}") for k in keys])


def status(v: Column) -> Column:
    """Scalar status; text, state or message of a status object; else the scalar inside ``data``."""
    named = F.coalesce(*[F.nullif(_text(v, f"$.status.{k}"), F.lit("")) for k in ("text", "state", "message")])
    return F.when(_is_object(v, "$.status"), named).otherwise(
        F.coalesce(_scalar(v, "$.status"), _scalar(v, "$.data.status")))


def event_type(v: Column) -> Column:
    return F.coalesce(*[_string(v, f"$.{k}") for k in ("event", "type", "action")])


def at_path(v: Column, path: str, kind: str = "string", default=None) -> Column:
    """Value at a path, or the default where any step is missing or of another type."""
    got = F.try_variant_get(v, path, kind)
    return got if default is None else F.coalesce(got, F.lit(default))


def kept(v: Column, body) -> Column:
    """The body itself when it parsed (``v``), else ``{"raw": body}``."""
    b = F.col(body) if isinstance(body, str) else body
    return F.when(v.isNotNull(), b).otherwise(F.to_json(F.struct(b.alias("raw"))))
