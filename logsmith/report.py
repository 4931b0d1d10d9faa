"""End-to-end runs: the batch report and the live stream (the reference's run modes).

Batch: the raw lines are parsed once into the date-partitioned logs table;
every later table reads that Parquet table (column pruning, pushed filters).
Derived tables that several steps reuse (client features, the (ip, url)
edges, the minute x status and minute x client rollups) are written once as
Parquet scratch tables: several reports are re-aggregations of them instead of
scans of the logs, and a lost executor does not send any step back to the raw text.  Every export is
computed once (Parquet) and copied to JSON/CSV from that copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.operators import kpis, metrics, panels
from logsmith.operators import lloyd as L
from logsmith.scratch import stored
from logsmith.session import apply_defaults
from logsmith.sources import sinks
from logsmith.sources.logstore import parse_and_store, read_logs_table
from logsmith.sources.runs import Run
from logsmith.streaming import stream as S


# Presentation order of the exported tables (the reference returns its tables
# sorted this way; ``-`` marks descending); a key breaks ties so files are
# reproducible.  Sorting is a distributed range sort of result-sized tables.
PRESENTATION = {
    "access_per_hour": ["date", "hour"],
    "access_per_minute": ["minute"],
    "top_urls": ["-hit_count", "url"],
    "top_ips": ["-request_count", "ip"],
    "http_status": ["status", "status_category"],
    "errors": ["-error_count", "status", "url"],
    "traffic_volume": ["window_start"],
    "peaks": ["-access_count", "minute"],
    "suspicious_ips": ["-anomaly_score", "ip"],
    "suspicious_ips_zscore": ["-anomaly_score", "ip"],
    "ip_connectivity": ["-urls_visited", "ip"],
    "url_popularity": ["-unique_visitors", "url"],
    "community_sizes": ["-size", "label"],
    "high_error_edges": ["-error_count", "src", "dst"],
    "error_ips": ["-total_errors", "src"],
    "anomalous_top_urls": ["-count", "url"],
    "anomalous_by_hour": ["hour"],
    "alert_error_rate": ["minute"],
}


#: Tables with a number of rows bounded by construction: their CSV copy is one file.
SMALL_TABLES = frozenset({"top_urls", "top_ips", "http_status", "suspicious_ips", "suspicious_ips_zscore",
                          "kmeans_quality", "anomalous_top_urls", "anomalous_by_hour", "anomalous_error_codes",
                          "status_summary", "parse_rejects", "metrics", "response_size_histogram",
                          "panel_overview", "community_samples"})


def run_batch_report(spark: SparkSession, lines: DataFrame, output_dir: str, k: int = 5,
                     lpa_steps: int = 5, run_id: str | None = None) -> DataFrame:
    """Parse, KPIs, anomaly scoring, graph analysis and exports; returns the export status table.

    The exports are a run (default id: the time) under ``metrics``: readers see it with its
    manifest, once all tables were tried, and earlier runs stay.  KPIs are exported before any
    model is fitted, so their files are there even if a later step fails.
    """
    apply_defaults(spark)
    out = output_dir.rstrip("/")
    run = Run(spark, f"{out}/metrics", run_id or sinks.new_run_id())
    rejects = parse_and_store(lines, f"{out}/logs")     # the only pass over the raw text
    logs = read_logs_table(spark, f"{out}/logs")

    def export(tables: dict[str, DataFrame]) -> DataFrame:
        return sinks.export_bundle(spark, tables, f"{out}/metrics", order=PRESENTATION,
                                   single_file=SMALL_TABLES, run=run)

    # per-minute x status counts, built once; status, peaks, counters and the
    # error-rate alert read it instead of the logs table
    rollup = stored(kpis.minute_rollup(logs), "report-rollup")
    # one edge per (ip, url), built once: top urls/ips, the vertex list and every
    # graph table are re-aggregations of it
    edges = stored(G.graph_edges(logs), "report-edges")
    # requests per (minute, client): the hourly, per-minute and 10-minute tables
    clients = stored(kpis.minute_client_rollup(logs), "report-clients")
    tables = kpis.all_kpis(logs, rollup, edges, clients)
    tables["status_summary"] = kpis.http_status_summary(logs, rollup)
    tables["parse_rejects"] = rejects
    status = export(tables)

    features = stored(A.client_features(logs), "report-features")
    zs = A.zscore_anomalies(features)
    scaled = stored(L.scaled_features(features, A.KMEANS_FEATURES), "report-kmeans")
    clustered = L.fit(scaled, k).assign(scaled)
    km = stored(A.kmeans_output(A.kmeans_anomalies(clustered)), "report-clusters")
    flagged_logs = stored(A.anomalous_requests(logs, km).select("url", "hour", "status", "is_error"), "report-flagged")
    g = G.AccessGraph(G.vertices_from_edges(edges), edges)
    communities = stored(G.label_propagation(g, max_iter=lpa_steps), "report-communities")
    status = status.unionByName(export({
        "suspicious_ips": A.suspicious_ips(km),
        "suspicious_ips_zscore": A.suspicious_ips(zs, score_col="max_z_score"),
        "kmeans_quality": L.quality(clustered, k),
        "anomalous_top_urls": A.anomalous_top_urls(flagged_logs),
        "anomalous_by_hour": A.anomalous_by_hour(flagged_logs),
        "anomalous_error_codes": A.anomalous_error_codes(flagged_logs),
        "ip_connectivity": G.ip_connectivity(edges),
        "url_popularity": G.url_popularity(edges),
        "community_sizes": G.community_sizes(communities),
        "community_samples": G.community_samples(communities),
        "high_error_edges": G.high_error_edges(edges),
        "error_ips": G.error_ips(edges),
        "rule_labels": A.rule_labels(features, edges),
        "metrics": metrics.metrics_snapshot(logs, km, rollup),
        "response_size_histogram": metrics.response_size_histogram(logs),
        "panel_overview": panels.overview(logs),
        "alert_error_rate": panels.alert_error_rate(logs, rollup=rollup),
    }))
    sinks.export_graph(g.vertices, edges, out)
    run.commit()
    return status


def start_live_stream(spark: SparkSession, source_dir: str, output_dir: str,
                      max_files_per_trigger: int | None = 1, processing_time: str | None = S.TRIGGER,
                      available_now: bool = False, state_partitions: int | None = None) -> dict:
    """The streaming mode: parsed rows and window metrics to Parquet, per-minute
    series to the memory table ``live_minutes``; returns the started queries.

    Started again on the same output, the Parquet queries go on from their checkpoints.  The
    memory table cannot be recovered: it has no checkpoint and is rebuilt from the source.
    """
    apply_defaults(spark)
    out = output_dir.rstrip("/")
    parsed = S.parsed_log_stream(spark, source_dir, max_files_per_trigger)
    ckpt = f"{out}/checkpoints"
    return {
        "live_logs": S.write_to_parquet(parsed.drop("processing_time"), f"{out}/live_logs", ckpt, "live_logs",
                                        processing_time, available_now),
        "window_metrics": S.write_to_parquet(S.window_metrics(parsed), f"{out}/streaming_metrics", ckpt,
                                             "streaming_metrics", processing_time, available_now,
                                             partitions=state_partitions),
        "live_minutes": S.write_to_memory(S.minute_counts(parsed), "live_minutes", processing_time,
                                          available_now, partitions=state_partitions),
    }
