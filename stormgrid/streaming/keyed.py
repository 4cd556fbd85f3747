"""Keyed state of jobs: the newest status of each, and alarms on jobs that stay open, both with ``transformWithState``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from . import jobs

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; sessions of ours name it, in others the default is replaced."""
    if "HDFSBacked" in spark.conf.get(_PROVIDER):
        spark.conf.set(_PROVIDER, _ROCKS)


def _micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


class NewestStatus(StatefulProcessor):
    """One value per job: time and status of its newest event; a row comes out whenever that changes."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "at long, status string", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a null status is before any other of the same time
        rank = lambda at, status: (at, status is not None, status or "")                            # noqa: E731
        old = rank(*self.newest.get()) if self.newest.exists() else None
        best = old
        for pdf in rows:
            for at, status in zip(_micros(pdf["received_at"]).tolist(), pdf["status"].tolist()):
                if best is None or rank(at, status) > best:
                    best = rank(at, status)
        if best != old:
            status = best[2] if best[1] else None
            self.newest.update((best[0], status))
            yield pd.DataFrame({"job_id": [key[0]], "status": pd.Series([status], dtype=object),
                                "received_at": pd.to_datetime([best[0]], unit="us")})


def status_changes(events: DataFrame, keep_hours: int | None = None) -> DataFrame:
    """``(job_id, status, received_at)``: a row for every event that made a job's newest status, at most one per job and micro-batch.

    The state is one value per job. With ``keep_hours`` it is dropped that long (of processing time) after its last
    change; an older event that arrives still later then comes out too, and readers rank it by its time.
    """
    keyed_state(events.sparkSession)
    keep = None if keep_hours is None else keep_hours * 3_600_000
    return events.where("job_id is not null").select("job_id", "status", "received_at").groupBy("job_id").transformWithStateInPandas(
        NewestStatus(keep), "job_id string, status string, received_at timestamp_ntz", "Append", "None" if keep is None else "ProcessingTime")


class Overdue(StatefulProcessor):
    """Alarm ``wait_ms`` after a job's first event unless an end of the job is at most as old; all times are event time."""

    def __init__(self, wait_ms: int, keep_ms: int):
        self.wait_ms, self.keep_ms = wait_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # first event; first end of the job (none: null); told: the alarm was given or the job has ended in time
        self.job = handle.getValueState("job", "first long, ended long, told boolean")

    def _set(self, first, ended, told, timer) -> None:
        self.job.update((first, ended, told))
        for old in list(self.handle.listTimers()):
            if old != timer:
                self.handle.deleteTimer(old)
        self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, ended, told = self.job.get() if self.job.exists() else (None, None, False)
        last = 0
        for pdf in rows:
            at = _micros(pdf["event_time"].dt.tz_localize(None))
            low, last = int(at.min()), max(last, int(at.max()))
            first = low if first is None else min(first, low)
            if pdf["done"].any():
                ended = min([int(at[pdf["done"]].min())] + ([] if ended is None else [ended]))
        now = timerValues.getCurrentWatermarkInMs()
        if told:
            self._set(first, ended, True, max(last // 1000, now) + self.keep_ms)
        else:
            self._set(first, ended, False, max(first // 1000 + self.wait_ms, now + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, ended, told = self.job.get()
        if told:
            self.job.clear()
            return
        self._set(first, ended, True, max(first // 1000, timerValues.getCurrentWatermarkInMs()) + self.keep_ms)
        if ended is None or ended > first + self.wait_ms * 1000:
            yield pd.DataFrame({"job_id": [key[0]], "first_seen": pd.to_datetime([first], unit="us")})


def overdue_jobs(events: DataFrame, seconds: int = 300, delay: str = "1 minute", keep_seconds: int = 86_400) -> DataFrame:
    """``(job_id, first_seen)`` once for every job without a terminal state within ``seconds`` of its first event.

    The alarm is an event-time timer, so the answer does not depend on the order of arrival as long as no event is
    later than ``delay``. A job that was reported or has ended is remembered for ``keep_seconds`` of event time, so that late or
    repeated events do not open it anew; then its state is gone. Events without a job id move the clock only.
    """
    keyed_state(events.sparkSession)
    # a condition on job_id alone would be moved below the watermark, where such events no longer count
    named = F.when(F.col("event_time").isNotNull(), F.col("job_id")).isNotNull()
    timed = (events.withColumn("event_time", F.col("received_at").cast("timestamp")).withWatermark("event_time", delay)
             .where(named).select("job_id", "event_time", jobs.is_terminal().alias("done")))
    return timed.groupBy("job_id").transformWithStateInPandas(
        Overdue(seconds * 1000, keep_seconds * 1000), "job_id string, first_seen timestamp_ntz", "Append", "EventTime")
