"""Name a value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    Projects are merged by inlining, and a lambda body runs per element, so a parsed or computed value
    would otherwise be computed again at every use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
