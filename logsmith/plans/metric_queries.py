"""Registered queries: metrics (X1-X9), dashboard panels and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.operators import metrics as X
from logsmith.operators import panels as D
from logsmith.plans.anomaly_queries import EDGES_CTE, ZSCORE_CTES
from logsmith.plans.oracle import with_logs
from logsmith.plans.registry import logs_table, register
from logsmith.scratch import stored
from logsmith.session import scratch_path
from logsmith.sources.runs import Run

SNAPSHOT_CTE = ZSCORE_CTES + """,
snapshot AS (
  SELECT 'log_requests_total' AS name, 'counter' AS kind, 'status_category' AS label_key,
         status_category AS label_value, CAST(count(*) AS DOUBLE) AS value FROM logs GROUP BY status_category
  UNION ALL SELECT 'log_unique_ips', 'gauge', '', '', CAST(count(DISTINCT ip) AS DOUBLE) FROM logs
  UNION ALL SELECT 'log_errors_total', 'counter', 'status_code', CAST(status AS VARCHAR), CAST(count(*) AS DOUBLE)
            FROM logs WHERE is_error = 1 GROUP BY status
  UNION ALL SELECT 'log_bytes_transferred_total', 'counter', '', '', CAST(coalesce(sum(bytes), 0) AS DOUBLE) FROM logs
  UNION ALL SELECT 'log_requests_per_minute', 'gauge', '', '',
            CAST(count(*) FILTER (WHERE date_trunc('minute', "timestamp") =
                 (SELECT date_trunc('minute', max("timestamp")) - INTERVAL 1 MINUTE FROM logs)) AS DOUBLE)
            FROM logs WHERE "timestamp" IS NOT NULL
  UNION ALL SELECT 'log_anomalous_ips', 'gauge', '', '', CAST(coalesce(sum(is_anomaly), 0) AS DOUBLE) FROM flagged)"""


def _bucket_sql() -> str:
    parts = []
    for bound, label in X.SIZE_BUCKETS:
        cond = "TRUE" if bound == float("inf") else f"bytes <= {bound}"
        parts.append(f"SELECT 'log_response_size_bytes_bucket' AS name, '{label}' AS le, "
                     f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) AS value FROM obs")
    parts.append("SELECT 'log_response_size_bytes_count', '', CAST(count(*) AS DOUBLE) FROM obs")
    parts.append("SELECT 'log_response_size_bytes_sum', '', CAST(coalesce(sum(bytes), 0) AS DOUBLE) FROM obs")
    return "\nUNION ALL ".join(parts)


HIST_CTE = ("obs AS (SELECT bytes FROM logs WHERE bytes IS NOT NULL AND bytes <> 0),\n"
            f"hist AS ({_bucket_sql()})")


def _snapshot(spark, sf_dir):
    logs = logs_table(spark, sf_dir)
    return X.metrics_snapshot(logs, A.zscore_anomalies(A.client_features(logs)))


@register("metrics_snapshot", "X1 X2 X3 X4 X6 X7", with_logs("SELECT * FROM snapshot", SNAPSHOT_CTE))
def metrics_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir)


@register("response_size_histogram", "X5", with_logs("SELECT * FROM hist", HIST_CTE))
def response_size_histogram(spark, sf_dir):
    return X.response_size_histogram(logs_table(spark, sf_dir))


@register("metrics_running_total", "X8", with_logs("""
SELECT 'log_requests_total' AS name, date AS run_id, status_category AS label_value, count(*) AS increment,
       CAST(sum(count(*)) OVER (PARTITION BY status_category ORDER BY date ASC NULLS FIRST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM logs GROUP BY date, status_category"""))
def metrics_running_total(spark, sf_dir):
    return X.metrics_running_total(logs_table(spark, sf_dir))


_RUNS = "CASE WHEN date < '2024-01-11' THEN 'run-0001' WHEN date < '2024-01-21' THEN 'run-0002' ELSE 'run-0003' END"


@register("metrics_stored_counters", "X8 (stored runs)", with_logs("""
SELECT name, label_key, label_value, run_id, increment,
       sum(increment) OVER (PARTITION BY name, label_key, label_value ORDER BY run_id) AS running_total
FROM (SELECT 'log_requests_total' AS name, 'status_category' AS label_key, status_category AS label_value, run_id,
             CAST(count(*) AS DOUBLE) AS increment FROM runs GROUP BY ALL
      UNION ALL SELECT 'log_errors_total', 'status_code', CAST(status AS VARCHAR), run_id, CAST(count(*) AS DOUBLE)
      FROM runs WHERE is_error = 1 GROUP BY ALL
      UNION ALL SELECT 'log_bytes_transferred_total', '', '', run_id, CAST(sum(bytes) AS DOUBLE) FROM runs GROUP BY ALL)""",
                                                                  f"runs AS (SELECT *, {_RUNS} AS run_id FROM logs)"))
def metrics_stored_counters(spark, sf_dir):
    """Three runs store their metric tables; the second is wrong at first and written again."""
    logs = stored(logs_table(spark, sf_dir).withColumn("run", F.expr(_RUNS)), "metric-runs")
    base = scratch_path(spark, "metric-runs-base")

    def write(run_id: str, part):
        with Run(spark, base, run_id) as run:
            run.write("metrics", X.metrics_snapshot(part.drop("run")))
    write("run-0001", logs.where("run = 'run-0001'"))
    write("run-0002", logs)                                # a mistake: all days
    write("run-0003", logs.where("run = 'run-0003'"))
    write("run-0002", logs.where("run = 'run-0002'"))
    return X.stored_counters(spark, base)


_NUM = "CAST(CAST(value AS BIGINT) AS VARCHAR)"


@register("metrics_text", "X9", with_logs(f"""
SELECT CASE WHEN label_key = '' THEN name || ' ' || {_NUM}
            ELSE name || '{{' || label_key || '="' || label_value || '"}} ' || {_NUM} END AS line FROM snapshot
UNION ALL
SELECT CASE WHEN le = '' THEN name || ' ' || {_NUM}
            ELSE name || '{{le="' || le || '"}} ' || {_NUM} END FROM hist""", SNAPSHOT_CTE + ",\n" + HIST_CTE))
def metrics_text(spark, sf_dir):
    logs = logs_table(spark, sf_dir)
    snap = X.metrics_snapshot(logs, A.zscore_anomalies(A.client_features(logs)))
    return X.metrics_text(snap, X.response_size_histogram(logs))


@register("panel_overview", "D1", with_logs("""
SELECT count(*) AS total_requests, count(DISTINCT ip) AS unique_ips, CAST(sum(is_error) AS BIGINT) AS error_count,
       (SELECT count(*) FROM (SELECT minute FROM logs WHERE minute IS NOT NULL GROUP BY minute)) AS active_minutes,
       (SELECT round(avg(n), 6) FROM (SELECT minute, count(*) AS n FROM logs WHERE minute IS NOT NULL
                                      GROUP BY minute)) AS avg_requests_per_minute,
       round(CAST(sum(is_error) AS DOUBLE) / count(*), 6) AS error_rate
FROM logs"""))
def panel_overview(spark, sf_dir):
    return D.overview(logs_table(spark, sf_dir))


@register("panel_status_share", "D2", with_logs("""
SELECT status_category, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 2) AS share_pct
FROM logs GROUP BY status_category"""))
def panel_status_share(spark, sf_dir):
    return D.status_share(logs_table(spark, sf_dir))


_BUCKET = "CASE WHEN max_z_score IS NULL THEN NULL ELSE CAST(floor(max_z_score / 0.5) AS INTEGER) END"


@register("panel_score_histogram", "D3", with_logs(f"""
SELECT {_BUCKET} AS bucket, count(*) AS count, CAST({_BUCKET} * 0.5 AS DOUBLE) AS bucket_start
FROM flagged GROUP BY 1""", ZSCORE_CTES))
def panel_score_histogram(spark, sf_dir):
    return D.score_histogram(A.zscore_anomalies(A.client_features(logs_table(spark, sf_dir))))


@register("panel_error_heatmap", "D3", with_logs(
    "SELECT hour, status, count(*) AS count FROM logs WHERE is_error = 1 GROUP BY hour, status"))
def panel_error_heatmap(spark, sf_dir):
    return D.error_heatmap(logs_table(spark, sf_dir))


@register("panel_ip_url_heatmap", "D4", with_logs("""
SELECT src, dst, weight FROM edges
WHERE src IN (SELECT ip FROM logs GROUP BY ip ORDER BY count(*) DESC, ip ASC LIMIT 10)
  AND dst IN (SELECT url FROM logs GROUP BY url ORDER BY count(*) DESC, url ASC LIMIT 10)""", EDGES_CTE))
def panel_ip_url_heatmap(spark, sf_dir):
    return D.ip_url_heatmap(G.graph_edges(logs_table(spark, sf_dir)))


PM_CTE = """pm AS (
  SELECT date_trunc('minute', "timestamp") AS minute_ts, count(*) AS request_count,
         CAST(sum(is_error) AS BIGINT) AS error_count
  FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1)"""


@register("alert_error_rate", "D5", with_logs("""
SELECT strftime(minute_ts, '%Y-%m-%d %H:%M') AS minute, request_count, error_count,
       round(error_rate, 6) AS error_rate, CAST(breach AS INTEGER) AS breach,
       CAST(count(*) FILTER (WHERE breach) OVER (ORDER BY minute_ts
            RANGE BETWEEN INTERVAL 4 MINUTES PRECEDING AND CURRENT ROW) = 5 AS INTEGER) AS firing
FROM (SELECT *, CAST(error_count AS DOUBLE) / request_count AS error_rate,
             CAST(error_count AS DOUBLE) / request_count > 0.1 AS breach FROM pm)""", PM_CTE))
def alert_error_rate(spark, sf_dir):
    return D.alert_error_rate(logs_table(spark, sf_dir))


@register("alert_anomaly", "D6", with_logs("""
SELECT CAST(coalesce(sum(is_anomaly), 0) AS BIGINT) AS anomalous_ips, 5 AS threshold,
       CAST(coalesce(sum(is_anomaly), 0) > 5 AS INTEGER) AS firing FROM flagged""", ZSCORE_CTES))
def alert_anomaly(spark, sf_dir):
    return D.alert_anomaly(A.zscore_anomalies(A.client_features(logs_table(spark, sf_dir))))


@register("alert_traffic_spike", "D7", with_logs("""
SELECT strftime(minute_ts, '%Y-%m-%d %H:%M') AS minute, request_count, threshold,
       CAST(breach AS INTEGER) AS breach,
       CAST(count(*) FILTER (WHERE breach) OVER (ORDER BY minute_ts
            RANGE BETWEEN INTERVAL 4 MINUTES PRECEDING AND CURRENT ROW) = 5 AS INTEGER) AS firing
FROM (SELECT pm.*, thr.threshold, request_count > thr.threshold AS breach FROM pm CROSS JOIN
      (SELECT CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY request_count) AS DOUBLE) AS threshold
       FROM pm) thr)""", PM_CTE))
def alert_traffic_spike(spark, sf_dir):
    return D.alert_traffic_spike(logs_table(spark, sf_dir))
