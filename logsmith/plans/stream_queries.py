"""Registered queries: the streaming path.

Each query writes the fixture lines as text files into a fresh folder under
the shared checkpoint directory, streams that folder with ``availableNow``
(every file is processed, then the query stops), and returns what the sink
holds.  All files are taken in one micro-batch, so no row can arrive behind
the watermark; ordering, late rows and restarts are covered by the tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from logsmith.operators.parsing import parse_logs
from logsmith.plans.oracle import with_lines, with_logs
from logsmith.plans.registry import register
from logsmith.session import scratch_path
from logsmith.sources.fixtures import event_line, event_log_lines, read_table, spread
from logsmith.sources.text import read_log_text, write_log_text
from logsmith.streaming import alerts, progress
from logsmith.streaming import stream as S


def _feed(spark, sf_dir) -> str:
    src = scratch_path(spark, "stream-src")
    write_log_text(event_log_lines(spark, sf_dir), src)
    return src


def _run_parquet(spark, df, name: str):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = S.write_to_parquet(df, out, ckpt, f"{name}_{uuid.uuid4().hex[:8]}", available_now=True,
                           partitions=spark.sparkContext.defaultParallelism)
    S.run_to_completion(q)
    return q, out


STREAM_COLUMNS = ["ip", "timestamp", "method", "url", "protocol", "status", "bytes", "hour", "is_error"]


@register("stream_parse", "S2 P6 T2 S9", with_logs(
    'SELECT ip, "timestamp", method, url, protocol, status, bytes, hour, is_error FROM logs'))
def stream_parse(spark, sf_dir):
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    _, out = _run_parquet(spark, parsed.select(*STREAM_COLUMNS), "stream_parse")
    return spark.read.parquet(out)


WINDOW_SQL = """
SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, count(*) AS request_count,
       CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(is_error) AS BIGINT) AS error_count
FROM (SELECT time_bucket(INTERVAL '10 seconds', "timestamp") - k * INTERVAL '10 seconds' AS window_start,
             bytes, is_error, ip
      FROM logs CROSS JOIN range(6) AS t(k) WHERE "timestamp" IS NOT NULL)
GROUP BY window_start
HAVING window_start + INTERVAL '1 minute' <= (SELECT max("timestamp") FROM logs) - INTERVAL '10 minutes'"""


def _within_bound(table, exact, key: str):
    """``table`` with the exact distinct clients beside it and whether its sketch is within the bound."""
    near = F.abs(F.col("unique_ips") - F.col("exact_ips")) <= F.greatest(
        F.lit(1.0), F.col("exact_ips") * S.CLIENT_SKETCH_BOUND)
    return table.join(exact, key).withColumn("within_bound", near).drop("unique_ips")


@register("stream_window_metrics", "T1 T3 S9", with_logs(WINDOW_SQL.replace(
    "AS error_count", "AS error_count, count(DISTINCT ip) AS exact_ips, true AS within_bound")))
def stream_window_metrics(spark, sf_dir):
    """The windows that the stream stored; their client sketches against an exact batch count."""
    src = _feed(spark, sf_dir)
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=None)
    _, out = _run_parquet(spark, S.window_metrics(parsed), "stream_window_metrics")
    exact = (parse_logs(read_log_text(spark, src)).where("timestamp IS NOT NULL")
             .groupBy(F.window("timestamp", S.WINDOW, S.SLIDE).alias("w"))
             .agg(F.countDistinct("ip").alias("exact_ips")).select(F.col("w.start").alias("window_start"), "exact_ips"))
    windows = spark.read.parquet(out).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "request_count", "total_bytes", "error_count", "unique_ips")
    return _within_bound(windows, exact, "window_start")


_CLOSED = """FROM logs WHERE date_trunc('minute', "timestamp") + INTERVAL '1 minute'
      <= (SELECT max("timestamp") FROM logs) - INTERVAL '10 minutes'"""


@register("stream_merged_windows", "T1 (merged sketches)", with_logs("\nUNION ALL ".join(f"""
SELECT '{unit}' AS unit, date_trunc('{unit}', "timestamp") + INTERVAL '0 seconds' AS span_start,
       count(*) AS request_count, CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(is_error) AS BIGINT) AS error_count,
       count(DISTINCT ip) AS exact_ips, true AS within_bound
{_CLOSED} GROUP BY ALL""" for unit in ("hour", "day"))))
def stream_merged_windows(spark, sf_dir):
    """Hours and days merged from the stored windows; the exact counts beside them read the logs."""
    src = _feed(spark, sf_dir)
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=None)
    _, out = _run_parquet(spark, S.window_metrics(parsed), "stream_merged_windows")
    windows = spark.read.parquet(out)
    logs = parse_logs(read_log_text(spark, src)).withColumn("minute_start", F.date_trunc("minute", "timestamp"))
    closed = logs.join(windows.select(F.col("window.start").alias("minute_start")), "minute_start", "left_semi")
    parts = []
    for unit in ("hour", "day"):
        exact = closed.groupBy(F.date_trunc(unit, "timestamp").alias("span_start")).agg(
            F.countDistinct("ip").alias("exact_ips"))
        merged = S.merge_windows(windows, unit).select(
            F.lit(unit).alias("unit"), "span_start", "request_count", "total_bytes", "error_count", "unique_ips")
        parts.append(_within_bound(merged, exact, "span_start"))
    return parts[0].unionByName(parts[1])


def _alert_sql(breach: str, minutes: int) -> str:
    return with_logs(f"""
SELECT minute_start, strftime(minute_start, '%Y-%m-%d %H:%M') AS minute, request_count, error_count,
       CAST(breach AS INTEGER) AS breach, CAST(now AS INTEGER) AS firing,
       CASE WHEN now AND NOT before THEN 'firing' WHEN before AND NOT now THEN 'resolved' END AS event
FROM (SELECT *, count(*) FILTER (breach) OVER (ORDER BY minute_start RANGE BETWEEN INTERVAL {minutes - 1} MINUTES
                    PRECEDING AND CURRENT ROW) = {minutes} AS now,
             count(*) FILTER (breach) OVER (ORDER BY minute_start RANGE BETWEEN INTERVAL {minutes} MINUTES
                    PRECEDING AND INTERVAL 1 MINUTE PRECEDING) = {minutes} AS before
      FROM judged)
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max("timestamp") FROM logs) - INTERVAL 10 MINUTES""", f"""pm AS (
  SELECT date_trunc('minute', "timestamp") AS minute_start, count(*) AS request_count,
         CAST(sum(is_error) AS BIGINT) AS error_count
  FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1),
judged AS (
  SELECT minute_start, coalesce(request_count, 0) AS request_count, coalesce(error_count, 0) AS error_count,
         coalesce({breach}, false) AS breach
  FROM (SELECT DISTINCT minute_start + k * INTERVAL 1 MINUTE AS minute_start FROM pm, range({minutes + 1}) AS t(k)) grid
  LEFT JOIN pm USING (minute_start))""")


@register("live_alert_error_rate", "D5 (live)", _alert_sql("error_count / request_count > 0.1", 5))
def live_alert_error_rate(spark, sf_dir):
    """The error-rate rule on the stream; every judged minute, with firing and resolved events."""
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    _, out = _run_parquet(spark, alerts.live_alerts(parsed, alerts.error_rate_above()), "live_alert_error_rate")
    return spark.read.parquet(out)


@register("live_alert_traffic", "D7 (live)", _alert_sql("request_count > 0", 2))
def live_alert_traffic(spark, sf_dir):
    """Any traffic for two minutes: a rule that fires and is resolved often on this sparse log."""
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    _, out = _run_parquet(spark, alerts.live_alerts(parsed, alerts.requests_above(0), for_minutes=2), "live_alert_traffic")
    return spark.read.parquet(out)


@register("stream_memory_table", "S10 T9", with_logs("""
SELECT minute, count(*) AS request_count, CAST(sum(is_error) AS BIGINT) AS error_count
FROM logs WHERE "timestamp" IS NOT NULL
GROUP BY minute
HAVING max(date_trunc('minute', "timestamp")) + INTERVAL '1 minute'
       <= (SELECT max("timestamp") FROM logs) - INTERVAL '10 minutes'"""))
def stream_memory_table(spark, sf_dir):
    """Per-minute live series in the memory sink, then SQL over the in-memory table."""
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    name = f"live_minutes_{uuid.uuid4().hex[:8]}"
    S.run_to_completion(S.write_to_memory(S.minute_counts(parsed), name, available_now=True,
                                          checkpoint_dir=scratch_path(spark, "memory-ckpt"),
                                          partitions=spark.sparkContext.defaultParallelism))
    return spark.sql(f"SELECT minute, request_count, error_count FROM {name}")


@register("stream_latest_errors", "T9", with_logs("""
SELECT ip, "timestamp", url, status FROM logs WHERE is_error = 1
ORDER BY "timestamp" DESC, ip ASC, url ASC, status ASC LIMIT 20"""))
def stream_latest_errors(spark, sf_dir):
    """Dashboard panel "latest errors" over the live table the Parquet sink keeps."""
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    _, out = _run_parquet(spark, parsed.select(*STREAM_COLUMNS), "live_logs")
    live = spark.read.parquet(out)
    return (live.filter(F.col("is_error") == 1).select("ip", "timestamp", "url", "status")
            .orderBy(F.desc("timestamp"), "ip", "url", "status").limit(20))


@register("stream_requests_per_second", "T9", with_logs("""
SELECT date_trunc('second', "timestamp") AS second, count(*) AS request_count
FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1"""))
def stream_requests_per_second(spark, sf_dir):
    """Dashboard panel "requests per second" over the live table."""
    parsed = S.parsed_log_stream(spark, _feed(spark, sf_dir), max_files_per_trigger=None)
    _, out = _run_parquet(spark, parsed.select(*STREAM_COLUMNS), "live_logs")
    return (spark.read.parquet(out).filter(F.col("timestamp").isNotNull())
            .groupBy(F.date_trunc("second", F.col("timestamp")).alias("second"))
            .agg(F.count(F.lit(1)).alias("request_count")))


#: More files, so more micro-batches, than a query object remembers reports of.
PROGRESS_FILES = 110


@register("stream_progress", "T4 T5 T7", with_lines(f"""
SELECT CAST({PROGRESS_FILES} AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS num_input_rows,
       CAST(0 AS BIGINT) AS rows_dropped_by_watermark FROM lines"""))
def stream_progress(spark, sf_dir):
    """One file per micro-batch (the reference's rate limit); totals of all reports of the run."""
    src, log = scratch_path(spark, "progress-src"), scratch_path(spark, "progress-log")
    write_log_text(event_log_lines(spark, sf_dir).repartition(PROGRESS_FILES), src)
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=1)
    with progress.logged_progress(spark, log):
        q = (parsed.select(*STREAM_COLUMNS).writeStream.format("noop").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", scratch_path(spark, "progress-ckpt")).start())
        S.run_to_completion(q)
    reports = progress.read_progress(spark, log).where(F.col("query_id") == str(q.id))
    return progress.progress_totals(reports).select("batches", "num_input_rows", "rows_dropped_by_watermark")


LATE_FROM = "2024-01-10 00:00:00"   # rows before this instant are delivered last


@register("stream_late_drops", "T5 T6", with_logs(WINDOW_SQL.replace(
    'FROM logs CROSS JOIN range(6) AS t(k) WHERE "timestamp" IS NOT NULL',
    f'FROM logs CROSS JOIN range(6) AS t(k) WHERE "timestamp" >= TIMESTAMP \'{LATE_FROM}\'').replace(
    'SELECT max("timestamp") FROM logs', 'SELECT max("timestamp") FROM logs WHERE "timestamp" IS NOT NULL')))
def stream_late_drops(spark, sf_dir):
    """Late delivery: the later days arrive first, the earlier days after a restart.

    The first run processes the first delivery and moves the watermark past it;
    the second delivery is written afterwards into the same folder and processed
    by the restarted query (same checkpoint), 20 days behind the watermark, so
    all of its rows are dropped.  The sink then holds the first delivery's windows.
    """
    ev = spread(read_table(spark, sf_dir, "events"), "event_id")
    line = event_line(*[F.col(c) for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]])
    cut = F.lit(LATE_FROM).cast("timestamp_ntz")
    src = scratch_path(spark, "late-src")
    out, ckpt = scratch_path(spark, "late-out"), scratch_path(spark, "late-ckpt")
    name = f"late_{uuid.uuid4().hex[:8]}"

    def run():
        parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=None)
        S.run_to_completion(S.write_to_parquet(S.window_metrics(parsed), out, ckpt, name, available_now=True,
                                               partitions=spark.sparkContext.defaultParallelism))

    write_log_text(ev.filter(F.col("ts") >= cut).select(line.alias("value")), src)
    run()
    write_log_text(ev.filter(~(F.col("ts") >= cut) | F.col("ts").isNull()).select(line.alias("value")), src,
                   mode="append")
    run()
    return spark.read.parquet(out).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "request_count", "total_bytes", "error_count")
