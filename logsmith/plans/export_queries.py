"""Registered queries: sink round trips, versioned exports, the export bundle."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.operators import kpis
from logsmith.plans import kpi_queries, metric_queries, parse_queries  # noqa: F401 - their texts are used below
from logsmith.plans.anomaly_queries import EDGES_CTE
from logsmith.plans.graph_queries import VERTICES_CTE
from logsmith.plans.oracle import with_lines, with_logs
from logsmith.plans.registry import logs_table, register, registered_oracles
from logsmith.report import run_batch_report
from logsmith.scratch import stored
from logsmith.session import scratch_path
from logsmith.sources import sinks
from logsmith.sources.fixtures import event_line, event_log_lines, read_table, spread
from logsmith.sources.ingest import add_batch, ingest_counts, ingest_new_files
from logsmith.sources.logstore import LOGS_SCHEMA
from logsmith.sources.runs import Run, manifest_tables, read_run
from logsmith.sources.text import write_log_text

ACCESS_PER_HOUR_SQL = """
SELECT date, hour, count(*) AS access_count, count(DISTINCT ip) AS unique_ips,
       CAST(sum(bytes) AS BIGINT) AS total_bytes, round(avg(bytes), 6) AS avg_bytes
FROM logs GROUP BY date, hour"""


@register("sink_parquet_roundtrip", "S3 S13", with_logs(ACCESS_PER_HOUR_SQL))
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpi-parquet")
    sinks.write_parquet(kpis.access_per_hour(logs_table(spark, sf_dir)), path)
    return spark.read.parquet(path)


TOP_IPS_SCHEMA = ("ip string, request_count long, unique_urls long, total_bytes long, "
                  "error_count long, error_rate double")


@register("sink_json_roundtrip", "S4", with_logs(
    f"SELECT * FROM ({kpi_queries.IP_ACTIVITY_SQL}) ORDER BY request_count DESC, ip ASC LIMIT 20"))
def sink_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpi-json")
    sinks.write_json(kpis.top_ips(logs_table(spark, sf_dir)), path)
    return spark.read.schema(TOP_IPS_SCHEMA).json(path)


ERRORS_SCHEMA = "status int, url string, error_count long, affected_ips long"


@register("sink_csv_roundtrip", "S5", with_logs("""
SELECT status, url, count(*) AS error_count, count(DISTINCT ip) AS affected_ips
FROM logs WHERE status >= 400 GROUP BY status, url"""))
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpi-csv") + "/errors.csv"
    sinks.write_single_csv(kpis.errors(logs_table(spark, sf_dir)), path)
    return sinks.read_single_csv(spark, path, ERRORS_SCHEMA)


EDGES_SCHEMA = "src string, dst string, weight long, total_bytes long, error_count long"


@register("graph_export_roundtrip", "S8", with_logs("SELECT * FROM edges", EDGES_CTE))
def graph_export_roundtrip(spark, sf_dir):
    g = G.build_graph(logs_table(spark, sf_dir))
    _, e = sinks.export_graph(g.vertices, g.edges, scratch_path(spark, "graph"))
    return sinks.read_csv(spark, e, EDGES_SCHEMA)


@register("graph_vertices_roundtrip", "S8", with_logs("SELECT id, type FROM vertices", VERTICES_CTE))
def graph_vertices_roundtrip(spark, sf_dir):
    g = G.build_graph(logs_table(spark, sf_dir))
    v, _ = sinks.export_graph(g.vertices, g.edges, scratch_path(spark, "graph"))
    return sinks.read_csv(spark, v, "id string, type string")


@register("export_versions", "S6", with_logs(
    "SELECT 'run-0002' AS run_id, * FROM (" + ACCESS_PER_HOUR_SQL + ")"))
def export_versions(spark, sf_dir):
    """Two runs as partitions, the second written twice as a retry does; the latest is read back."""
    base = scratch_path(spark, "versions")
    table = kpis.access_per_hour(logs_table(spark, sf_dir))
    sinks.write_version(table, base, "run-0001")
    sinks.write_version(table, base, "run-0002")
    sinks.write_version(table, base, "run-0002")
    return sinks.latest_version(spark, base)


def _count_sql(names: dict[str, str]) -> str:
    """name, row_count of registered queries, from their own DuckDB texts."""
    texts = registered_oracles()
    return "\nUNION ALL ".join(f"SELECT '{name}' AS name, (SELECT count(*) FROM ({texts[key]})) AS row_count"
                               for name, key in names.items())


#: Tables of the bundle and the registered query that each one is.
BUNDLE = {name: name for name in ("access_per_hour", "access_per_minute", "top_urls", "top_ips", "http_status", "errors",
                                  "traffic_volume", "peaks", "ip_connectivity", "url_popularity")} | {
    "suspicious_ips": "suspicious_ips_stat"}


@register("export_bundle", "S7", f"""
SELECT k.name, f.format, true AS ok, k.row_count AS manifest_rows, k.row_count
FROM ({_count_sql(BUNDLE)}) k CROSS JOIN (SELECT unnest(['parquet', 'json', 'csv']) AS format) f""")
def export_bundle(spark, sf_dir):
    """Every KPI and three further tables as a run in three formats; each copy is read back by its manifest."""
    logs = stored(logs_table(spark, sf_dir), "bundle-logs")
    shared = kpis.shared_tables(logs)
    edges = shared["edges"]
    tables = kpis.all_kpis(logs, **shared) | {
        "suspicious_ips": A.suspicious_ips(A.zscore_anomalies(A.client_features(logs)), score_col="max_z_score"),
        "ip_connectivity": G.ip_connectivity(edges), "url_popularity": G.url_popularity(edges)}
    base = scratch_path(spark, "bundle")
    with Run(spark, base, "run-0001") as run:
        status = sinks.export_bundle(spark, tables, base, run=run, single_file=frozenset({"http_status", "top_urls"}))
    return _read_back(spark, base, status)


def _read_back(spark, base, status):
    """name, format, ok, rows by the manifest and rows read back of each write (a few dozen)."""
    named = manifest_tables(spark, base).select(F.col("table").alias("name"), "format", F.col("row_count").alias("manifest_rows"))
    counts = None
    for r in status.where("ok").collect():
        options = sinks.CSV_OPTIONS | {"emptyValue": ""} if r.format == "csv" else {}
        one = read_run(spark, base, r.name, fmt=r.format, **options).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(r.name).alias("name"), F.lit(r.format).alias("format"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return status.select("name", "format", "ok").join(named, ["name", "format"], "left").join(
        stored(counts, "bundle-counts"), ["name", "format"], "left")


@register("export_manifest", "S6 S7", with_logs("""
SELECT run_id, "table", 'parquet' AS format, row_count
FROM (SELECT 'run-0001' AS run_id, 'access_per_hour' AS "table", count(*) AS row_count FROM (SELECT DISTINCT date, hour FROM logs)
      UNION ALL SELECT 'run-0002', 'access_per_hour', count(*) FROM (SELECT DISTINCT date, hour FROM logs)
      UNION ALL SELECT 'run-0002', 'errors', count(*) FROM (SELECT DISTINCT status, url FROM logs WHERE status >= 400))"""))
def export_manifest(spark, sf_dir):
    """Three runs, of which one dies between its tables and one is written twice: what readers see."""
    base = scratch_path(spark, "runs")
    logs = stored(logs_table(spark, sf_dir), "runs-logs")
    hourly, errors = kpis.access_per_hour(logs), kpis.errors(logs)
    with Run(spark, base, "run-0001") as run:
        run.write("access_per_hour", hourly)
    for part in (hourly.where("hour = 0"), hourly):
        with Run(spark, base, "run-0002") as run:
            run.write("access_per_hour", part)
            run.write("errors", errors)
    try:
        with Run(spark, base, "run-0003") as run:
            run.write("access_per_hour", hourly)
            raise InterruptedError("the run dies here")
    except InterruptedError:
        pass
    return manifest_tables(spark, base).select("run_id", "table", "format", "row_count")


@register("ingest_incremental", "S1 P5 (incremental)", with_lines("""
SELECT CASE WHEN event_id % 3 > 0 THEN 'events-000000000' ELSE 'events-000000001' END AS ingest, count(*) AS line_count,
       count(*) FILTER (event_id % 101 > 0) AS accepted, count(*) FILTER (event_id % 101 > 0) AS stored
FROM events, (SELECT count(*) FROM lines) GROUP BY ALL"""))
def ingest_incremental(spark, sf_dir):
    """Two deliveries of files; the second run reads the new ones only, and its batch is repeated as after a failure."""
    ev = spread(read_table(spark, sf_dir, "events"), "event_id")
    line = event_line(*[F.col(c) for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]])
    src, table = scratch_path(spark, "ingest-src"), scratch_path(spark, "ingest-logs")
    checkpoint = scratch_path(spark, "ingest-ckpt")
    second = ev.where("event_id % 3 = 0").select(line.alias("value"))
    write_log_text(ev.where("event_id % 3 > 0").select(line.alias("value")), src)
    ingest_new_files(spark, src, table, checkpoint, "events")
    write_log_text(second, src, mode="append")
    ingest_new_files(spark, src, table, checkpoint, "events")
    ingest_new_files(spark, src, table, checkpoint, "events")       # nothing new
    add_batch(second, table, "events-000000001")
    there = (spark.read.schema(LOGS_SCHEMA + ", ingest string").parquet(table).groupBy("ingest")
             .agg(F.count(F.lit(1)).alias("stored")))
    return ingest_counts(spark, table).join(there, "ingest")


#: Tables of the batch report that a registered query gives too.
REPORT = BUNDLE | {name: name for name in (
    "suspicious_ips", "kmeans_quality", "community_sizes", "community_samples", "high_error_edges", "error_ips", "rule_labels", "response_size_histogram",
    "panel_overview", "alert_error_rate", "parse_rejects")} | {
    "suspicious_ips_zscore": "suspicious_ips_stat", "status_summary": "http_status_summary", "metrics": "metrics_snapshot"}


@register("batch_report", "A9 S7 (batch run mode)", f"""
SELECT name, format, true AS ok, row_count FROM ({_count_sql(REPORT)}), (SELECT unnest(['parquet', 'json', 'csv']) AS format)
UNION ALL
SELECT name, format, true, CAST(NULL AS BIGINT)
FROM (SELECT unnest(['anomalous_top_urls', 'anomalous_by_hour', 'anomalous_error_codes']) AS name), (SELECT unnest(['parquet', 'json', 'csv']) AS format), (SELECT count(*) FROM events)""")
def batch_report(spark, sf_dir):
    """The whole batch mode: parse once to the date-partitioned table, every report table from it, exports.

    The status of each write with the rows by its manifest (NULL for the behaviour of clients that K-Means
    flags, which no other query gives)."""
    out = scratch_path(spark, "batch-report")
    status = run_batch_report(spark, event_log_lines(spark, sf_dir), out)
    named = manifest_tables(spark, f"{out}/metrics").select(F.col("table").alias("name"), "format", "row_count")
    told = F.when(F.col("name").isin(*REPORT), F.col("row_count"))
    return status.select("name", "format", "ok").join(named, ["name", "format"], "left").withColumn("row_count", told)
