"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion into the ``noop`` sink (the whole plan
executes, nothing is collected) after one warm-up run of the parser, and timed
wall-clock.  Prints one JSON line: total seconds over all queries plus the
per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_logs", "access_per_hour", "access_per_minute", "top_urls", "top_ips", "http_status",
    "errors", "traffic_volume", "peaks", "client_features", "zscore_anomalies", "anomalous_requests",
    "kmeans_anomalies", "graph_edges", "ip_connectivity", "url_popularity", "high_error_edges",
    "communities", "connected_components", "metrics_snapshot", "response_size_histogram",
    "alert_error_rate", "stream_window_metrics",
    # the whole batch mode: parse once, every report table, all exports
    "batch_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE

    from logsmith.plans.registry import registry
    from logsmith.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="logsmith-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()

    def run(key: str) -> float:
        t0 = time.perf_counter()
        reg[key].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("parse_logs")  # warm-up: JVM, codegen caches, file listing
    times = {k: round(run(k), 3) for k in keys}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
