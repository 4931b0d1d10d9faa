"""Command line: ``python -m logsmith --mode batch --data LOGS --output OUT``.

Modes follow the reference's: ``batch`` (parse, KPIs, anomalies, graph,
exports), ``streaming`` (watch a directory and keep the live tables), ``all``.
``--export-metrics`` writes the metric table and its text exposition form
(there is no metrics server).
"""

from __future__ import annotations

import argparse
import sys


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="logsmith", description="Access-log analytics on Spark")
    ap.add_argument("--mode", choices=["batch", "streaming", "all"], default="all")
    ap.add_argument("--data", required=True, help="log file, directory or glob")
    ap.add_argument("--output", default="output")
    ap.add_argument("--k-clusters", type=int, default=5)
    ap.add_argument("--stream-dir", help="directory the streaming mode watches (default: --data)")
    ap.add_argument("--stream-seconds", type=float, default=120.0,
                    help="how long the streaming mode runs; 0 processes what is there and stops")
    ap.add_argument("--export-metrics", action="store_true")
    return ap.parse_args(argv)


def run(spark, args: argparse.Namespace) -> int:
    """Returns how many exports and streaming queries failed."""
    from logsmith.operators import anomaly as A
    from logsmith.operators import metrics
    from logsmith.operators.parsing import parse_logs
    from logsmith.report import run_batch_report, start_live_stream
    from logsmith.sources.logstore import read_logs_table
    from logsmith.sources.text import read_log_text
    from logsmith.streaming.progress import logged_progress
    from logsmith.streaming.stream import stop_all_queries

    out = args.output.rstrip("/")
    failures = 0
    if args.mode in ("batch", "all"):
        status = run_batch_report(spark, read_log_text(spark, args.data), out, k=args.k_clusters)
        failed = status.filter("NOT ok").count()
        failures += failed
        print(f"batch report written to {out}; {failed} export(s) failed")
    if args.mode in ("streaming", "all"):
        once = args.stream_seconds <= 0
        with logged_progress(spark, f"{out}/stream/progress"):
            queries = start_live_stream(spark, args.stream_dir or args.data, f"{out}/stream", available_now=once)
            if once:
                for q in queries.values():
                    q.processAllAvailable()
            else:
                # the watch ends early if the query does
                queries["live_logs"].awaitTermination(args.stream_seconds)
            for name, q in queries.items():
                if q.exception() is not None:
                    failures += 1
                    print(f"streaming query {name} failed: {q.exception()}")
            stop_all_queries(spark)
    if args.export_metrics:
        # reuse the parsed table of the batch mode; parse only when it was not run
        logs = (read_logs_table(spark, f"{out}/logs") if args.mode in ("batch", "all")
                else parse_logs(read_log_text(spark, args.data)))
        features = A.kmeans_input(A.client_features(logs))
        flagged = A.kmeans_anomalies(A.fit_kmeans(features, k=args.k_clusters).transform(features))
        snap = metrics.metrics_snapshot(logs, A.kmeans_output(flagged))
        snap.write.mode("overwrite").parquet(f"{out}/metrics_table")
        metrics.metrics_text(snap, metrics.response_size_histogram(logs)).coalesce(1) \
            .write.mode("overwrite").text(f"{out}/metrics_text")
    return failures


def main(argv: list[str] | None = None) -> int:
    from logsmith.session import build_session
    args = parse_args(argv)
    spark = build_session(app_name="logsmith")
    try:
        failures = run(spark, args)
    finally:
        spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
