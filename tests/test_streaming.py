"""Streaming: file order, late rows behind the watermark, restart from checkpoint, sinks."""

import os
import time
import uuid

from pyspark.sql import functions as F

from helpers import lines_df
from logsmith.operators.panels import alert_error_rate
from logsmith.operators.parsing import parse_logs
from logsmith.streaming import alerts as L
from logsmith.streaming import progress as P
from logsmith.streaming import stream as S


def line(day: int, hh: int, mm: int, ip: str = "10.0.0.9", status: int = 200) -> str:
    return f'{ip} - - [{day:02d}/Jan/2024:{hh:02d}:{mm:02d}:00 +0000] "GET /p/{day} HTTP/1.0" {status} 100'


def feed(directory: str, files: list[list[str]]) -> None:
    """Write each file with a distinct, ascending modification time (ties come in any order)."""
    base = time.time() - 1000
    for i, lines in enumerate(files):
        path = os.path.join(directory, f"chunk_{i:04d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))


def run_windows(spark, src, out, ckpt, name):
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=1)
    q = S.write_to_parquet(S.window_metrics(parsed), out, ckpt, name, available_now=True)
    S.run_to_completion(q, 300)
    return q


def window_rows(spark, out):
    return {(r.start, r.request_count) for r in spark.read.parquet(out).select(
        F.col("window.start").alias("start"), "request_count").collect()}


def test_late_file_is_dropped(spark, tmpdir_fresh):
    src, out, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    # day 10, then day 20 (moves the watermark), then day 1: the day-1 rows are late
    feed(src, [[line(10, 12, 0)], [line(20, 12, 0), line(20, 13, 0)], [line(1, 12, 0)]])
    q = run_windows(spark, src, out, ckpt, f"late_{uuid.uuid4().hex[:6]}")
    starts = {r.start for r in spark.read.parquet(out).select(F.col("window.start").alias("start")).collect()}
    days = {s.day for s in starts}
    assert 10 in days and 1 not in days
    progress = S.recent_progress(spark, q).collect()
    assert sum(r.rows_dropped_by_watermark for r in progress) > 0
    assert sum(r.num_input_rows for r in progress) == 4


def test_restart_adds_no_duplicates(spark, tmpdir_fresh):
    src, out, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    files = [[line(1, 10, m) for m in range(0, 30, 3)], [line(1, 11, m) for m in range(0, 30, 3)],
             [line(1, 12, m) for m in range(0, 30, 3)]]
    feed(src, files[:2])
    run_windows(spark, src, out, ckpt, "restart")
    first = window_rows(spark, out)
    feed_more = os.path.join(src, "chunk_9999.txt")
    with open(feed_more, "w") as f:
        f.write("\n".join(files[2]) + "\n")
    os.utime(feed_more, (time.time(), time.time()))
    run_windows(spark, src, out, ckpt, "restart")
    second = spark.read.parquet(out).select(F.col("window.start").alias("start"), "request_count")
    assert second.count() == second.distinct().count()
    assert first <= {(r.start, r.request_count) for r in second.collect()}

    # the same as one uninterrupted run over all three files
    src2, out2, ckpt2 = (os.path.join(tmpdir_fresh, d) for d in ("src2", "out2", "ckpt2"))
    os.makedirs(src2)
    feed(src2, files)
    run_windows(spark, src2, out2, ckpt2, "restart_c")
    assert window_rows(spark, out) == window_rows(spark, out2)


def test_stream_equals_batch_below_watermark(spark, tmpdir_fresh):
    src, out, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    lines = [line(2, h, m, ip=f"10.0.0.{m % 3}", status=404 if m % 4 == 0 else 200)
             for h in range(3) for m in range(0, 60, 7)]
    feed(src, [lines])
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=None)
    S.run_to_completion(S.write_to_parquet(S.window_metrics(parsed), out, ckpt, "eq", available_now=True), 300)
    got = spark.read.parquet(out).select(F.col("window.start").alias("s"), "request_count", "error_count")
    logs = parse_logs(lines_df(spark, lines))
    max_ts = logs.agg(F.max("timestamp")).first()[0]
    batch = (logs.groupBy(F.window("timestamp", "1 minute", "10 seconds"))
             .agg(F.count(F.lit(1)).alias("request_count"), F.sum("is_error").alias("error_count"))
             .filter(F.col("window.end") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
             .select(F.col("window.start").alias("s"), "request_count", "error_count"))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_memory_sink_and_stop_all(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    feed(src, [[line(3, 1, m) for m in range(30)], [line(3, 2, m) for m in range(30)]])
    parsed = S.parsed_log_stream(spark, src)
    name = f"mem_{uuid.uuid4().hex[:6]}"
    q = S.write_to_memory(S.minute_counts(parsed), name, available_now=True)
    S.run_to_completion(q, 300)
    rows = spark.sql(f"SELECT sum(request_count) AS n FROM {name}").first().n
    assert rows is not None and rows > 0
    assert S.stop_all_queries(spark) == 0
    running = S.write_to_memory(S.minute_counts(parsed), f"run_{uuid.uuid4().hex[:6]}")
    assert running.isActive and S.stop_all_queries(spark) == 1 and not running.isActive


def test_live_mode_starts_again_on_its_output(spark, tmpdir_fresh):
    from logsmith.report import start_live_stream
    src, out = os.path.join(tmpdir_fresh, "src"), os.path.join(tmpdir_fresh, "out")
    os.makedirs(src)
    for day in (3, 4):
        with open(os.path.join(src, f"day_{day}.txt"), "w") as f:
            f.write("\n".join(line(day, 1, m) for m in range(20)) + "\n")
        queries = start_live_stream(spark, src, out, available_now=True)
        for q in queries.values():
            S.run_to_completion(q, 300)
    assert spark.read.parquet(f"{out}/live_logs").count() == 40


def test_one_absurd_size_does_not_stop_the_windows(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    big = [line(3, 1, m).rsplit(" ", 1)[0] + " 9223372036854775807" for m in range(3)]
    feed(src, [big, [line(3, 2, m) for m in range(30)]])
    q = S.write_to_memory(S.window_metrics(S.parsed_log_stream(spark, src)), f"big_{uuid.uuid4().hex[:6]}", available_now=True)
    S.run_to_completion(q, 300)


def test_console_sink(spark, tmpdir_fresh, capfd):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    feed(src, [[line(4, 1, m) for m in range(3)]])
    parsed = S.parsed_log_stream(spark, src).select("ip", "timestamp", "method", "url", "status", "bytes")
    q = S.write_to_console(parsed, os.path.join(tmpdir_fresh, "ckpt"), "console_out", available_now=True)
    S.run_to_completion(q, 300)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3


def test_monitor_query_returns_progress(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    feed(src, [[line(5, 1, m) for m in range(5)], [line(5, 2, m) for m in range(5)]])
    parsed = S.parsed_log_stream(spark, src).drop("processing_time")
    log = os.path.join(tmpdir_fresh, "log")
    q = S.write_to_parquet(parsed, os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ckpt"), "monitored")
    table = P.monitor_query(spark, q, log, duration_seconds=15, interval_seconds=1)
    q.stop()
    # the watch begins after the start, so the first batch may have been reported before
    assert sum(r.num_input_rows for r in table.collect()) <= 10 and P.read_progress(spark, log).count() == table.count()


def test_progress_log_keeps_all_reports_and_a_restart_adds_to_it(spark, tmpdir_fresh):
    src, out, ckpt, log = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt", "log"))
    os.makedirs(src)
    feed(src, [[line(1 + i % 28, i % 24, m) for m in range(1 + i % 3)] for i in range(150)])

    def run():
        with P.logged_progress(spark, log, flush_reports=20) as listener:
            q = (S.parsed_log_stream(spark, src).writeStream.format("noop").queryName("many").trigger(availableNow=True)
                 .option("checkpointLocation", ckpt).start())
            S.run_to_completion(q, 600)
        return q, listener

    q, _ = run()
    assert len(q.recentProgress) <= 100 < P.read_progress(spark, log).count() == 150
    assert len([f for f in os.listdir(log) if f.endswith(".json")]) >= 8          # not one file per report
    with open(os.path.join(src, "late.txt"), "w") as f:
        f.write(line(9, 9, 9) + "\n")
    run()
    [total] = P.progress_totals(P.read_progress(spark, log)).collect()
    assert total["name"] == "many" and total.batches == 151
    assert total.num_input_rows == sum(1 + i % 3 for i in range(150)) + 1


def test_progress_rows_wait_for_a_store_that_fails(spark, tmpdir_fresh, monkeypatch):
    log = P.ProgressLog(spark, os.path.join(tmpdir_fresh, "log"))
    log._rows = [{"query_id": "a", "batch_id": 0}, {"query_id": "a", "batch_id": 1}]
    real = P.write_text

    def broken(*args):
        raise OSError("no store")
    monkeypatch.setattr(P, "write_text", broken)
    log._write()
    assert len(log._rows) == 2
    monkeypatch.setattr(P, "write_text", real)
    log.drain()
    assert log._rows == [] and P.read_progress(spark, log.path).count() == 2


def test_sliding_windows_multiply_slots_not_lines(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    feed(src, [[line(2, 1, m) for m in range(20)]])
    static = parse_logs(lines_df(spark, [line(2, 1, m) for m in range(20)]))
    plan = S.window_metrics(static)._jdf.queryExecution().optimizedPlan().toString()
    # the only Expand is above the slots' aggregation
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("Aggregate")


def test_merged_windows_count_clients_once(spark, tmpdir_fresh):
    src, out, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    lines = [line(2, h, m, ip=f"10.{c // 250}.0.{c % 250}") for h in (1, 2) for m in range(0, 60, 10) for c in range(900)]
    feed(src, [lines + [line(3, 1, 0)]])
    parsed = S.parsed_log_stream(spark, src, max_files_per_trigger=None)
    S.run_to_completion(S.write_to_parquet(S.window_metrics(parsed), out, ckpt, "merge", available_now=True), 300)
    windows = spark.read.parquet(out)
    hours = {r.span_start.hour: r for r in S.merge_windows(windows, "hour").collect()}
    [day] = S.merge_windows(windows, "day").collect()
    assert {h: r.request_count for h, r in hours.items()} == {1: 5400, 2: 5400} and day.request_count == 10800
    for row in (*hours.values(), day):
        assert abs(row.unique_ips - 900) <= 900 * S.CLIENT_SKETCH_BOUND
    assert day.total_bytes == 10800 * 100


def alert_rows(spark, tmpdir_fresh, lines, rule, for_minutes):
    src, out, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    feed(src, lines)
    parsed = S.parsed_log_stream(spark, src)
    q = S.write_to_parquet(L.live_alerts(parsed, rule, for_minutes), out, ckpt, f"alert_{uuid.uuid4().hex[:6]}",
                           available_now=True)
    S.run_to_completion(q, 600)
    return {r.minute[-5:]: r for r in spark.read.parquet(out).collect()}


def test_live_alert_fires_and_is_resolved(spark, tmpdir_fresh):
    bad, good = (lambda m: line(2, 1, m, status=500)), (lambda m: line(2, 1, m))
    minutes = [good(0)] + [bad(m) for m in range(1, 8)] + [good(8), good(8)] + [bad(m) for m in range(9, 13)] + [good(13)]
    minutes += [bad(m) for m in range(20, 26)]                                       # ends in silence
    rows = alert_rows(spark, tmpdir_fresh, [minutes[:9], minutes[9:], [line(2, 2, 0)]], L.error_rate_above(0.1), 5)
    assert {m for m, r in rows.items() if r.firing} == {"01:05", "01:06", "01:07", "01:24", "01:25"}
    assert {(m, r.event) for m, r in rows.items() if r.event} == {
        ("01:05", "firing"), ("01:08", "resolved"), ("01:24", "firing"), ("01:26", "resolved")}
    assert rows["01:08"].request_count == 2 and rows["01:26"].request_count == 0 and rows["01:26"].breach == 0


def test_live_alert_equals_batch_alert_behind_the_watermark(spark, tmpdir_fresh):
    import random
    rng = random.Random(4)
    lines = [line(2, h, m, status=rng.choice([200, 200, 500])) for h in range(2) for m in range(60)
             for _ in range(rng.choice([0, 1, 1, 2]))]
    got = alert_rows(spark, tmpdir_fresh, [lines[:70], lines[70:], [line(2, 3, 0)]], L.error_rate_above(0.4), 2)
    batch = alert_error_rate(parse_logs(lines_df(spark, lines)), 0.4, 2).collect()
    assert sum(r.firing for r in batch) > 5
    for r in batch:
        live = got[r.minute[-5:]]
        assert (live.request_count, live.error_count, live.breach, live.firing) == (
            r.request_count, r.error_count, r.breach, r.firing)
