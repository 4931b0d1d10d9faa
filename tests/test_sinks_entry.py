"""Sinks, exports and the driver contract."""

import glob
import os

import duckdb

from helpers import SF_SMALL
from logsmith.operators import kpis
from logsmith.operators.parsing import parse_logs
from logsmith.sources import sinks
from logsmith.sources.fixtures import event_log_lines
from logsmith.sources.runs import read_run, run_ids
from logsmith.streaming.progress import read_progress


def test_single_csv_and_directory(spark, tmpdir_fresh):
    logs = parse_logs(event_log_lines(spark, SF_SMALL))
    table = kpis.http_status_summary(logs)
    f = os.path.join(tmpdir_fresh, "summary.csv")
    assert sinks.write_single_csv(table, f) == f
    assert os.path.isfile(f)
    with open(f) as fh:
        assert fh.readline().strip() == "status_category,count"
    d = os.path.join(tmpdir_fresh, "any.csv")
    sinks.write_csv(table, d)
    assert os.path.isdir(d)


def test_csv_tells_null_from_empty(spark, tmpdir_fresh):
    table = spark.createDataFrame([("", 1), (None, 2), ("a\"b\\c", 3)], "url string, n int")
    f = os.path.join(tmpdir_fresh, "urls.csv")
    sinks.write_single_csv(table, f)
    assert sorted(sinks.read_csv(spark, f, "url string, n int").collect(), key=lambda r: r.n) == table.collect()


def test_versions_latest(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "versions")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    sinks.write_version(a, base, "20240101_000000")
    sinks.write_version(b, base, "20240102_000000")
    sinks.write_version(b, base, "20240102_000000")   # a retry of the same run
    latest = sinks.latest_version(spark, base)
    assert [r.x for r in latest.collect()] == [3]
    assert [r.run_id for r in latest.collect()] == ["20240102_000000"]
    # of the three attempts only the newest one's files are read
    assert {f.split("/attempts/")[1].split("/")[0] for f in latest.inputFiles()} == {
        max(n for n in os.listdir(os.path.join(base, "attempts")) if n.startswith("20240102"))}


def test_bundle_reports_each_write(spark, tmpdir_fresh):
    logs = parse_logs(event_log_lines(spark, SF_SMALL))
    tables = {"http_status": kpis.http_status(logs), "peaks": kpis.peaks(logs)}
    status = sinks.export_bundle(spark, tables, tmpdir_fresh, single_file=frozenset({"http_status"})).collect()
    assert len(status) == 6 and all(r.ok for r in status)
    assert os.path.isdir(os.path.join(tmpdir_fresh, "csv", "peaks.csv"))
    assert os.path.isfile(os.path.join(tmpdir_fresh, "csv", "http_status.csv"))


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"date", "hour", "access_count", "unique_ips", "total_bytes", "avg_bytes"}
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70


def test_every_oracle_text_runs_in_duckdb():
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("events", "documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(sql).fetchall()


def test_cli_batch_and_stream(spark, tmpdir_fresh):
    from logsmith.__main__ import parse_args, run
    from logsmith.sources.text import write_log_text
    data = os.path.join(tmpdir_fresh, "raw")
    write_log_text(event_log_lines(spark, SF_SMALL).coalesce(2), data)
    out = os.path.join(tmpdir_fresh, "out")
    failed = run(spark, parse_args(["--mode", "all", "--data", data, "--output", out, "--stream-seconds", "0",
                                    "--export-metrics"]))
    assert failed == 0
    assert os.path.isdir(os.path.join(out, "logs"))
    assert any(n.startswith("date=") for n in os.listdir(os.path.join(out, "logs")))
    [attempt] = os.listdir(os.path.join(out, "metrics", "attempts"))
    assert os.path.isdir(os.path.join(out, "metrics", "attempts", attempt, "csv", "access_per_hour.csv"))
    assert os.path.isfile(os.path.join(out, "metrics", "attempts", attempt, "csv", "http_status.csv"))
    assert len(run_ids(spark, os.path.join(out, "metrics"))) == 1
    assert read_run(spark, os.path.join(out, "metrics"), "http_status").count() > 0
    assert read_progress(spark, os.path.join(out, "stream", "progress")).count() > 0
    assert spark.read.parquet(os.path.join(out, "stream", "live_logs")).count() == \
        spark.read.parquet(os.path.join(out, "logs")).count()
    text = spark.read.text(os.path.join(out, "metrics_text")).collect()
    assert any(r.value.startswith("log_requests_total{status_category=") for r in text)


def test_exported_csv_is_in_presentation_order(spark, tmpdir_fresh):
    import csv
    from logsmith.report import PRESENTATION
    logs = parse_logs(event_log_lines(spark, "/root/testdata/sf0.01"))
    f = os.path.join(tmpdir_fresh, "hourly.csv")
    hourly = kpis.access_per_hour(logs).orderBy(*sinks.sort_columns(PRESENTATION["access_per_hour"]))
    sinks.write_single_csv(hourly, f)
    with open(f) as fh:
        rows = [(r["date"], int(r["hour"])) for r in csv.DictReader(fh)]
    assert rows == sorted(rows) and len(rows) == 720


def test_bundle_csv_keeps_order(spark, tmpdir_fresh):
    import csv
    from logsmith.report import PRESENTATION
    logs = parse_logs(event_log_lines(spark, "/root/testdata/sf0.01")).repartition(7)
    sinks.export_bundle(spark, {"access_per_minute": kpis.access_per_minute(logs)}, tmpdir_fresh,
                        order=PRESENTATION)
    # a directory of ranges: its part files, taken by name, are in order as a whole
    parts = sorted(glob.glob(os.path.join(tmpdir_fresh, "csv", "access_per_minute.csv", "part-*")))
    minutes = []
    for part in parts:
        with open(part) as fh:
            minutes += [r["minute"] for r in csv.DictReader(fh)]
    assert minutes == sorted(minutes) and len(minutes) > 1000


def test_modules_import_without_a_session():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r); import logsmith.report, logsmith.__main__; "
            "import __spark_entry__ as E; assert len(E.queries()) == len(set(E.queries()))" % os.path.dirname(
                os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)


def test_parse_and_store_counts_rejects_in_the_same_pass(spark, tmpdir_fresh):
    from logsmith.operators.parsing import parse_rejects
    from logsmith.sources.logstore import parse_and_store, read_logs_table
    lines = event_log_lines(spark, SF_SMALL)
    path = os.path.join(tmpdir_fresh, "logs")
    got = {r.accepted: r.line_count for r in parse_and_store(lines, path).collect()}
    want = {r.accepted: r.line_count for r in parse_rejects(lines).collect()}
    assert got == want and read_logs_table(spark, path).count() == want[True]
