"""A progress table that keeps every report of every query.

A query object remembers its last 100 reports only.  ``ProgressLog`` listens to the session's
streams and appends all reports to a folder of JSON lines: a few hundred bytes a batch, written
by the driver, which alone has them.  Files appear in one step, so the table can be read while
queries run, from any session, also after a restart.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logsmith.sources.files import make_folder, write_text

PROGRESS_LOG_SCHEMA = (
    "query_id string, run_id string, name string, batch_id long, reported_at timestamp, batch_ms long, "
    "num_input_rows long, input_rows_per_second double, processed_rows_per_second double, watermark timestamp, "
    "max_event_time timestamp, state_rows long, state_bytes long, rows_dropped_by_watermark long, output_rows long")


def report_row(progress) -> dict:
    """One report as a row of ``PROGRESS_LOG_SCHEMA``; what a source does not tell is NULL."""
    ops, times = progress.stateOperators or [], progress.eventTime or {}
    output = progress.sink.numOutputRows if progress.sink else None

    def rate(value):
        return value if value is not None and value == value and abs(value) != float("inf") else None
    return {
        "query_id": str(progress.id), "run_id": str(progress.runId), "name": progress.name,
        "batch_id": progress.batchId, "reported_at": progress.timestamp, "batch_ms": progress.batchDuration,
        "num_input_rows": progress.numInputRows, "input_rows_per_second": rate(progress.inputRowsPerSecond),
        "processed_rows_per_second": rate(progress.processedRowsPerSecond),
        "watermark": times.get("watermark"), "max_event_time": times.get("max"),
        "state_rows": sum(o.numRowsTotal for o in ops), "state_bytes": sum(o.memoryUsedBytes for o in ops),
        "rows_dropped_by_watermark": sum(o.numRowsDroppedByWatermark for o in ops),
        "output_rows": output if output is not None and output >= 0 else None}


class ProgressLog(StreamingQueryListener):
    """Appends every report of the session's queries to ``path``; register it with ``spark.streams``.

    Reports are kept until ``flush_reports`` have come, ``flush_seconds`` have passed since the
    last write or a query ends, then written as one file.  If a write fails they stay and go
    with the next one, so a short failure of the store loses nothing.
    """

    def __init__(self, spark: SparkSession, path: str, flush_reports: int = 50, flush_seconds: float = 60.0):
        self.spark, self.path = spark, make_folder(spark, path.rstrip("/"))
        self.flush_reports, self.flush_seconds = flush_reports, flush_seconds
        self._rows: list[dict] = []
        self._started: set[str] = set()
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        self._written_at = time.monotonic()
        self._no = 0
        self._name = uuid.uuid4().hex[:12]

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._started.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self._changed:
            self._rows.append(report_row(event.progress))
            due = time.monotonic() - self._written_at >= self.flush_seconds
            if due or len(self._rows) >= self.flush_reports:
                self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._write()
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _write(self, must: bool = False) -> None:
        if not self._rows:
            return
        self._no += 1
        text = "".join(json.dumps(r) + "\n" for r in self._rows)
        try:
            write_text(self.spark, f"{self.path}/{self._name}-{self._no:08d}.json", text)
        except Exception:  # noqa: BLE001 - the rows stay for the next write
            if must:
                raise
            return
        self._rows = []
        self._written_at = time.monotonic()

    def drain(self, timeout: float = 60.0) -> None:
        """Wait until the reports of all ended runs have come, then write what is left."""
        deadline = time.monotonic() + timeout
        active = {str(q.runId) for q in self.spark.streams.active}
        with self._changed:
            while (self._started - self._ended - active) and time.monotonic() < deadline:
                self._changed.wait(max(0.0, min(1.0, deadline - time.monotonic())))
            self._write(must=True)


@contextmanager
def logged_progress(spark: SparkSession, path: str, **options) -> Iterator[ProgressLog]:
    """All reports of the queries that run inside go to the table at ``path``."""
    log = ProgressLog(spark, path, **options)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        log.drain()
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Every report, one row each; a batch repeated after a restart has its last report only."""
    reports = spark.read.schema(PROGRESS_LOG_SCHEMA).json(path)
    columns = reports.columns
    last = reports.groupBy("query_id", "batch_id").agg(
        F.max_by(F.struct(*columns), F.struct("reported_at", "run_id")).alias("report"))
    return last.select("report.*")


def progress_totals(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows in, dropped and put out, seconds at work, slowest batch, latest watermark."""
    return progress.groupBy("query_id", "name").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("num_input_rows").alias("num_input_rows"),
        F.sum("rows_dropped_by_watermark").alias("rows_dropped_by_watermark"), F.sum("output_rows").alias("output_rows"),
        (F.sum("batch_ms") / 1000).alias("busy_seconds"), F.max("batch_ms").alias("slowest_ms"),
        F.max("watermark").alias("watermark"))


def monitor_query(spark: SparkSession, query: StreamingQuery, path: str, duration_seconds: float = 60.0,
                  interval_seconds: float = 10.0) -> DataFrame:
    """Watch a running query for ``duration_seconds`` (or until it stops) with a log at ``path``,
    then return its reports since then."""
    with logged_progress(spark, path) as log:
        log.onQueryStarted(query)
        deadline = time.monotonic() + duration_seconds
        while query.isActive and time.monotonic() < deadline:
            query.awaitTermination(min(interval_seconds, max(0.0, deadline - time.monotonic())))
    return read_progress(spark, path).where(F.col("query_id") == str(query.id))
