"""Job-status events: parsing, latest state, overdue jobs; batch and streaming share the expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import payload
from ..functions.binding import let

# States after which a job does not change
TERMINAL = ("complete", "failed", "Completed", "Failed", "Error")


def parse_events(df: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``received_at, job_id, status, event_type, payload``; a body that is not JSON is kept under ``raw``."""
    fields = let(payload.parse(body), lambda v: F.struct(
        payload.job_id(v).alias("job_id"), payload.status(v).alias("status"),
        payload.event_type(v).alias("event_type"), payload.kept(v, body).alias("payload")))
    # inline over a one-element array: parsed once, and not merged into what uses it
    return df.select(*keep, "received_at", F.inline(F.array(fields)))


def latest_status(events: DataFrame, tie: str | None = None) -> DataFrame:
    """Last status per job; ``tie`` orders events of the same instant."""
    order = F.struct("received_at", tie) if tie else F.col("received_at")
    return (events.where("job_id is not null").groupBy("job_id")
            .agg(F.max_by("status", order).alias("status"), F.max("received_at").alias("received_at"),
                 F.count("*").alias("num_events")))


def is_terminal(status: str = "status"):
    return F.coalesce(F.col(status).isin(*TERMINAL), F.lit(False))


def overdue(events: DataFrame, as_of: str, seconds: int = 300) -> DataFrame:
    """Jobs first seen more than ``seconds`` before ``as_of`` without a terminal state by then."""
    at = F.expr(f"TIMESTAMP_NTZ '{as_of}'")
    seen = (events.where(F.col("job_id").isNotNull() & (F.col("received_at") <= at)).groupBy("job_id")
            .agg(F.min("received_at").alias("first_seen"), F.max(is_terminal()).alias("done")))
    return seen.where(~F.col("done") & (F.col("first_seen") < at - F.expr(f"INTERVAL {int(seconds)} SECONDS"))).drop("done")
