"""Structured Streaming over a directory of log files.

The stream is parsed by the same function as the batch table (the parser is a
narrow projection, valid on a streaming DataFrame), aggregated into sliding
event-time windows under a watermark, and written with an append-mode sink
and a checkpoint per query, so a restarted query resumes where it stopped and
adds no duplicates.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsmith.functions.logline import minute_of
from logsmith.operators.common import total_bytes
from logsmith.operators.parsing import parse_stream
from logsmith.sources.text import read_log_stream

# The reference's stream settings.
WATERMARK = "10 minutes"
WINDOW = "1 minute"
SLIDE = "10 seconds"
TRIGGER = "10 seconds"

#: log2 of the registers of a client sketch: a relative standard error of 1.04 / sqrt(2**12), 1.6 %.
CLIENT_SKETCH_LGK = 12
#: Three standard errors; below a few hundred clients the sketch counts nearly exactly.
CLIENT_SKETCH_BOUND = 3 * 1.04 / 2 ** (CLIENT_SKETCH_LGK / 2)


def parsed_log_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """S2 + P6: watched directory -> parsed stream (with ``processing_time``)."""
    return parse_stream(read_log_stream(spark, source_dir, max_files_per_trigger))


def slot_metrics(parsed: DataFrame, watermark: str = WATERMARK, slot: str = SLIDE) -> DataFrame:
    """Requests, bytes, errors and a sketch of the clients per tumbling slot under a watermark.

    The sketch has a fixed size and can be merged, so longer spans never go back to the log
    lines.  Exact distinct counts are not supported on streams.
    """
    return (parsed.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", slot))
            .agg(F.count(F.lit(1)).alias("request_count"), F.sum(F.col("bytes").cast("decimal(38,0)")).alias("bytes_sum"),
                 F.sum("is_error").alias("error_count"), F.hll_sketch_agg("ip", CLIENT_SKETCH_LGK).alias("clients")))


def _merged() -> list[Column]:
    return [F.sum("request_count").alias("request_count"), total_bytes("bytes_sum").alias("total_bytes"),
            F.sum("error_count").alias("error_count"), F.hll_union_agg("clients").alias("clients")]


def window_metrics(parsed: DataFrame, watermark: str = WATERMARK, window: str = WINDOW,
                   slide: str = SLIDE) -> DataFrame:
    """Sliding event-time windows under a watermark.

    Log lines are counted once, in slots of the slide; a second aggregation slides over the
    slots, so only a row per slot is multiplied.  Window and slide must be such that the slots
    tile the windows.  ``clients`` is the sketch behind ``unique_ips``; ``merge_windows`` adds
    windows up to hours and days.  A line that comes later than the watermark allows counts in
    no window, also if one that spans its slot is still open.
    """
    slots = slot_metrics(parsed, watermark, slide)
    return (slots.groupBy(F.window(F.window_time("window"), window, slide)).agg(*_merged())
            .withColumn("unique_ips", F.hll_sketch_estimate("clients")))


def merge_windows(windows: DataFrame, unit: str = "hour", window_seconds: int = 60) -> DataFrame:
    """Stored windows (``window_metrics`` or ``slot_metrics`` with their length) added up to a
    larger unit (``hour``, ``day``) by merging their sketches; the logs are not read.

    Of sliding windows those that tile the time are taken: starts at multiples of the length.
    """
    total = F.col("total_bytes") if "total_bytes" in windows.columns else F.col("bytes_sum")
    tiles = windows.where(F.unix_timestamp(F.col("window.start")) % window_seconds == 0).withColumn(
        "bytes_sum", total.cast("decimal(38,0)"))
    return (tiles.groupBy(F.date_trunc(unit, F.col("window.start")).alias("span_start")).agg(*_merged())
            .withColumn("unique_ips", F.hll_sketch_estimate("clients")))


def minute_counts(parsed: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Requests and errors per minute (tumbling), the live dashboard's series."""
    return (parsed.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", "1 minute"))
            .agg(F.count(F.lit(1)).alias("request_count"), F.sum("is_error").alias("error_count"))
            .select(F.col("window.start").alias("minute_start"), minute_of(F.col("window.start")).alias("minute"),
                    "request_count", "error_count"))


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Number of state-store partitions for a stateful query started inside.

    A streaming aggregation keeps ``spark.sql.shuffle.partitions`` state
    partitions, fixed in its checkpoint at the first start; size it to the state
    (window keys), not to the batch job defaults.  The setting is restored after.
    """
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _start(writer, spark: SparkSession, partitions: int | None) -> StreamingQuery:
    with state_partitions(spark, partitions):
        return writer.start()


def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def write_to_parquet(df: DataFrame, output_path: str, checkpoint_dir: str, query_name: str,
                     processing_time: str | None = TRIGGER, available_now: bool = False,
                     partitions: int | None = None) -> StreamingQuery:
    """Append-mode Parquet sink; checkpoint at ``<checkpoint_dir>/<query_name>``."""
    writer = (df.writeStream.outputMode("append").format("parquet")
              .option("path", output_path)
              .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{query_name}")
              .queryName(query_name))
    return _start(_trigger(writer, processing_time, available_now), df.sparkSession, partitions)


def write_to_memory(df: DataFrame, query_name: str, processing_time: str | None = TRIGGER,
                    available_now: bool = False, checkpoint_dir: str | None = None,
                    partitions: int | None = None) -> StreamingQuery:
    """In-memory table ``query_name`` for interactive SQL.

    The memory sink keeps its rows in the driver, so it is meant for bounded
    streams (aggregates such as ``minute_counts``, or debugging); raw logs go to
    the Parquet sink.
    """
    writer = df.writeStream.outputMode("append").format("memory").queryName(query_name)
    if checkpoint_dir:
        writer = writer.option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{query_name}")
    return _start(_trigger(writer, processing_time, available_now), df.sparkSession, partitions)


def write_to_console(df: DataFrame, checkpoint_dir: str, query_name: str,
                     processing_time: str | None = TRIGGER, available_now: bool = False,
                     num_rows: int = 20) -> StreamingQuery:
    """Console sink (debug), no truncation."""
    writer = (df.writeStream.outputMode("append").format("console")
              .option("truncate", "false").option("numRows", num_rows)
              .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{query_name}")
              .queryName(query_name))
    return _trigger(writer, processing_time, available_now).start()


PROGRESS_SCHEMA = ("batch_id long, num_input_rows long, input_rows_per_second double, "
                   "processed_rows_per_second double, watermark string, rows_dropped_by_watermark long")


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The reports that the query object still remembers (its last 100) as a table, for a quick
    look; ``streaming.progress`` keeps all of them."""
    rows = []
    for p in query.recentProgress:
        ops = p.get("stateOperators") or []
        dropped = sum(int(o.get("numRowsDroppedByWatermark", 0) or 0) for o in ops)
        rows.append((int(p.get("batchId", -1)), int(p.get("numInputRows", 0) or 0),
                     float(p.get("inputRowsPerSecond", 0.0) or 0.0),
                     float(p.get("processedRowsPerSecond", 0.0) or 0.0),
                     (p.get("eventTime") or {}).get("watermark"), dropped))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def stop_all_queries(spark: SparkSession) -> int:
    """Stop every active query of the session; returns how many were stopped."""
    active = list(spark.streams.active)
    for q in active:
        q.stop()
    return len(active)


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its failure if any."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
