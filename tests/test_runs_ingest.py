"""Runs that appear in one step, counters over stored runs, incremental ingestion."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import lines_df
from logsmith.operators import metrics
from logsmith.operators.parsing import parse_logs
from logsmith.sources import sinks
from logsmith.sources.ingest import add_batch, ingest_counts, ingest_new_files
from logsmith.sources.logstore import read_logs_table
from logsmith.sources.runs import Run, manifest_files, manifest_tables, read_all_runs, read_run, run_ids, unread_attempts


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long").repartition(2)


def values(df):
    return sorted(r.x for r in df.collect())


def test_a_run_that_dies_between_tables_is_not_seen(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "runs")
    with pytest.raises(LookupError):
        read_run(spark, base, "a")
    assert manifest_files(spark, base).count() == 0
    with Run(spark, base, "r1") as run:
        run.write("a", numbers(spark, 1, 2))
        run.write("b", numbers(spark, 3))
    with pytest.raises(RuntimeError, match="killed"):
        with Run(spark, base, "r2") as run:
            run.write("a", numbers(spark, 7, 8, 9))
            raise RuntimeError("killed")
    half = Run(spark, base, "r3")
    half.write("a", numbers(spark, 5))                       # still at work
    assert run_ids(spark, base) == ["r1"]
    assert values(read_run(spark, base, "a")) == [1, 2] and values(read_run(spark, base, "b")) == [3]
    assert len(unread_attempts(spark, base, older_than_seconds=0)) == 2 and unread_attempts(spark, base) == []
    half.commit()
    assert values(read_run(spark, base, "a")) == [5]
    with pytest.raises(LookupError):
        read_run(spark, base, "b")                           # the newest run has no such table
    assert values(read_run(spark, base, "b", "r1")) == [3]
    with pytest.raises(RuntimeError):
        half.commit()


def test_a_rewritten_run_is_replaced_in_one_step(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "runs")
    slow = Run(spark, base, "r1")
    with Run(spark, base, "r1") as run:
        run.write("a", numbers(spark, 1))
    reader = read_run(spark, base, "a")
    slow.write("a", numbers(spark, 99))
    slow.commit()                                            # begun earlier, so it does not replace the later one
    assert values(read_run(spark, base, "a")) == [1]
    with Run(spark, base, "r1") as run:
        run.write("a", numbers(spark, 2, 3))
    assert values(reader) == [1]                             # a reader of before keeps its files
    assert values(read_run(spark, base, "a")) == [2, 3]
    with Run(spark, base, "r2") as run:
        run.write("a", numbers(spark, 4))
    both = read_all_runs(spark, base, "a")
    assert sorted((r.run_id, r.x) for r in both.collect()) == [("r1", 2), ("r1", 3), ("r2", 4)]
    table = {(r.run_id, r.table): (r.row_count, r.n_files) for r in manifest_tables(spark, base).collect()}
    assert table[("r1", "a")][0] == 2 and table[("r2", "a")][0] == 1


def test_lost_and_empty_tables(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "runs")
    with Run(spark, base, "r1") as run:
        run.write("none", numbers(spark, 1).where("x > 1"))
        path = run.write("a", numbers(spark, 1, 2, 3))
        with pytest.raises(ValueError):
            run.write("a", numbers(spark, 1))
    assert read_run(spark, base, "none").collect() == []
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    with open(os.path.join(path, part), "ab") as f:
        f.write(b"x")
    with pytest.raises(OSError, match="lost or changed"):
        read_run(spark, base, "a")
    with pytest.raises(ValueError):
        Run(spark, base, "a/b")


def test_bundle_in_a_run_names_what_succeeded(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "bundle")
    bad = numbers(spark, 1).select(F.raise_error(F.lit("broken table")).cast("long").alias("x"))
    with Run(spark, base, "r1") as run:
        status = sinks.export_bundle(spark, {"good": numbers(spark, 1, 2), "bad": bad}, base, run=run,
                                     single_file=frozenset({"good"})).collect()
    assert {(r.name, r.format): r.ok for r in status} == {(n, f): n == "good" for n in ("good", "bad")
                                                           for f in ("parquet", "json", "csv")}
    assert {(r.table, r.format, r.row_count) for r in manifest_tables(spark, base).collect()} == {
        ("good", f, 2) for f in ("parquet", "json", "csv")}
    assert values(read_run(spark, base, "good", fmt="csv", **sinks.CSV_OPTIONS)) == [1, 2]
    assert values(read_run(spark, base, "good", fmt="json")) == [1, 2]


def test_counters_over_runs_follow_a_rewritten_run(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "runs")

    def lines(day, n, status):
        return [f'10.0.0.1 - - [{day:02d}/Jan/2024:00:00:00 +0000] "GET /a HTTP/1.0" {status} 10'] * n

    def write(run_id, rows):
        with Run(spark, base, run_id) as run:
            run.write("metrics", metrics.metrics_snapshot(parse_logs(lines_df(spark, rows))))
    write("r1", lines(1, 4, 200))
    write("r2", lines(2, 50, 404))
    write("r3", lines(3, 5, 200) + lines(3, 1, 404))
    write("r2", lines(2, 2, 200))
    got = {(r.name, r.label_value, r.run_id): (r.increment, r.running_total)
           for r in metrics.stored_counters(spark, base).collect()}
    total = "log_requests_total"
    assert got[(total, "2xx_success", "r1")] == (4, 4) and got[(total, "2xx_success", "r2")] == (2, 6)
    assert got[(total, "2xx_success", "r3")] == (5, 11) and got[(total, "4xx_client_error", "r3")] == (1, 1)
    assert (total, "4xx_client_error", "r2") not in got
    assert got[("log_bytes_transferred_total", "", "r3")] == (60, 120)


def log_line(i):
    return f'10.0.0.{i % 7} - - [{1 + i % 3:02d}/Feb/2024:0{i % 10}:00:00 +0000] "GET /x/{i} HTTP/1.0" 200 {i}'


def put(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(rows) + "\n")


def test_ingestion_reads_new_files_only(spark, tmpdir_fresh):
    src, table, ckpt = (os.path.join(tmpdir_fresh, d) for d in ("src", "logs", "ckpt"))
    os.makedirs(src)
    put(src, "a.log", [log_line(i) for i in range(30)] + ["junk"])
    put(src, "b.log", [log_line(i) for i in range(30, 40)])
    q = ingest_new_files(spark, src, table, ckpt)
    assert sum(p["numInputRows"] for p in q.recentProgress) >= 41
    put(src, "c.log", [log_line(i) for i in range(40, 55)] + ["junk", "junk"])
    q = ingest_new_files(spark, src, table, ckpt)
    assert {r.ingest: (r.line_count, r.accepted) for r in ingest_counts(spark, table).collect()} == {
        "feed-000000000": (41, 40), "feed-000000001": (17, 15)}
    ingest_new_files(spark, src, table, ckpt)
    logs = read_logs_table(spark, table)
    assert sorted(r.bytes for r in logs.collect()) == list(range(55))
    # the same rows and types as a parse of everything
    whole = parse_logs(lines_df(spark, [log_line(i) for i in range(55)]))
    assert logs.columns == whole.columns and logs.exceptAll(whole.select(*logs.columns)).count() == 0


def test_a_repeated_batch_adds_no_rows(spark, tmpdir_fresh):
    table = os.path.join(tmpdir_fresh, "logs")
    first = lines_df(spark, [log_line(i) for i in range(20)])
    add_batch(first, table, "f-000000000")
    add_batch(lines_df(spark, [log_line(i) for i in range(20, 25)]), table, "f-000000001")
    add_batch(first.repartition(3), table, "f-000000000")
    assert sorted(r.bytes for r in read_logs_table(spark, table).collect()) == list(range(25))
    assert ingest_counts(spark, table).count() == 2


def test_two_feeds_share_a_table(spark, tmpdir_fresh):
    table, ckpt = os.path.join(tmpdir_fresh, "logs"), os.path.join(tmpdir_fresh, "ckpt")
    for feed, start in (("east", 0), ("west", 10)):
        src = os.path.join(tmpdir_fresh, feed)
        os.makedirs(src)
        put(src, "a.log", [log_line(i) for i in range(start, start + 10)])
        ingest_new_files(spark, src, table, ckpt, feed=feed)
    assert read_logs_table(spark, table).count() == 20
    plan = read_logs_table(spark, table).where("date = '2024-02-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    with pytest.raises(ValueError):
        ingest_new_files(spark, "/nowhere", table, ckpt, feed="a-b")


def test_drop_scratch_keeps_what_is_read(spark, tmpdir_fresh):
    from logsmith.scratch import drop_scratch, stored
    old, used = stored(numbers(spark, 1, 2), "old"), stored(numbers(spark, 3), "used")
    lazy = used.union(used).cache()
    assert drop_scratch(spark, lazy) == 0                        # not computed yet
    lazy.unpersist()
    joined = used.union(used)
    written = os.path.join(tmpdir_fresh, "out")
    old.write.parquet(written)
    assert drop_scratch(spark, joined) >= 1
    assert values(joined) == [3, 3] and values(spark.read.parquet(written)) == [1, 2]
    with pytest.raises(Exception):
        old.collect()
