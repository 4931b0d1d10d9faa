"""KPI tables.

Each is one hash aggregation (partial aggregation before the shuffle, final
after it); exact distinct counts.  Sorting happens only where the result is a
top-k (TakeOrderedAndProject) or at presentation; every ranked result has a
total order (metric desc, key asc) so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsmith.functions import logline as L
from logsmith.operators.common import one_row_broadcast, percentile_threshold, total_bytes
from logsmith.scratch import stored


def minute_client_rollup(logs: DataFrame) -> DataFrame:
    """Requests and bytes per (minute, ip).

    The per-hour, per-minute and 10-minute tables all count distinct clients
    over whole minutes; from this table they are exact re-aggregations (a
    client appears once per minute, the average is a bytes sum over a non-NULL
    count), so a batch run scans the logs once for all three.
    """
    return (logs.groupBy(F.date_trunc("minute", F.col("timestamp")).alias("minute_ts"), "ip")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes").cast("decimal(38,0)")).alias("bytes_sum"),
                 F.count("bytes").alias("bytes_cnt")))


def _client_rollup_aggs() -> list:
    return [F.sum("n").alias("access_count"), F.countDistinct("ip").alias("unique_ips"),
            total_bytes("bytes_sum").alias("total_bytes"),
            (F.sum("bytes_sum").cast("double") / F.sum("bytes_cnt")).alias("avg_bytes")]


def access_per_hour(logs: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """A1: by (date, hour); from ``minute_client_rollup`` when given."""
    if clients is not None:
        return (clients.groupBy(F.date_format("minute_ts", "yyyy-MM-dd").alias("date"),
                                F.hour("minute_ts").alias("hour"))
                .agg(*_client_rollup_aggs()))
    return (logs.groupBy("date", "hour")
            .agg(F.count(F.lit(1)).alias("access_count"),
                 F.countDistinct("ip").alias("unique_ips"),
                 total_bytes("bytes").alias("total_bytes"),
                 F.avg("bytes").alias("avg_bytes")))


def minute_rollup(logs: DataFrame) -> DataFrame:
    """Requests and bytes per (minute, status, status_category, is_error).

    Several reports (status distribution, peak minutes, metric counters, the
    error-rate alert) only need these counts; a batch run builds this small
    table once (minutes x status codes rows) instead of scanning the logs for
    each of them.  Rows with a NULL timestamp form the NULL minute.
    """
    return (logs.groupBy(F.date_trunc("minute", F.col("timestamp")).alias("minute_ts"),
                         "status", "status_category", "is_error")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes").cast("decimal(38,0)")).alias("bytes_sum")))


def per_minute_counts(logs: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    if rollup is not None:
        return (rollup.groupBy(L.minute_of(F.col("minute_ts")).alias("minute"))
                .agg(F.sum("n").alias("access_count")))
    return (logs.withColumn("minute", L.minute_of(F.col("timestamp")))
            .groupBy("minute").agg(F.count(F.lit(1)).alias("access_count")))


def access_per_minute(logs: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """A2: by ``yyyy-MM-dd HH:mm``; from ``minute_client_rollup`` when given
    (there each row is one client in one minute)."""
    if clients is not None:
        return (clients.groupBy(L.minute_of(F.col("minute_ts")).alias("minute"))
                .agg(F.sum("n").alias("access_count"), F.count(F.lit(1)).alias("unique_ips")))
    return (logs.withColumn("minute", L.minute_of(F.col("timestamp")))
            .groupBy("minute")
            .agg(F.count(F.lit(1)).alias("access_count"),
                 F.countDistinct("ip").alias("unique_ips")))


def top_urls(logs: DataFrame, top_n: int = 20, edges: DataFrame | None = None) -> DataFrame:
    """A3: the ``top_n`` urls by hits (limit is the feature).

    With the (ip, url) edge table at hand (``graph.graph_edges``) the same
    numbers are a re-aggregation of it: hits are summed weights, visitors are
    edges, so no distinct count and no scan of the logs.
    """
    if edges is not None:
        per_url = (edges.groupBy(F.col("dst").alias("url"))
                   .agg(F.sum("weight").alias("hit_count"), F.count(F.lit(1)).alias("unique_visitors"),
                        total_bytes("total_bytes").alias("total_bytes")))
    else:
        per_url = (logs.groupBy("url")
                   .agg(F.count(F.lit(1)).alias("hit_count"),
                        F.countDistinct("ip").alias("unique_visitors"),
                        total_bytes("bytes").alias("total_bytes")))
    return per_url.orderBy(F.desc("hit_count"), F.asc("url")).limit(top_n)


def ip_activity(logs: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Per-ip request, url, byte and error totals (A4 before the limit).

    ``error_rate`` is a percentage with two decimals, as in the reference's
    top-IP table (the feature table M1 keeps it as a fraction).  From the edge
    table when given (urls are edges, requests and errors summed).
    """
    if edges is not None:
        per_ip = (edges.groupBy(F.col("src").alias("ip"))
                  .agg(F.sum("weight").alias("request_count"), F.count(F.lit(1)).alias("unique_urls"),
                       total_bytes("total_bytes").alias("total_bytes"), F.sum("error_count").alias("error_count")))
    else:
        per_ip = (logs.groupBy("ip")
                  .agg(F.count(F.lit(1)).alias("request_count"),
                       F.countDistinct("url").alias("unique_urls"),
                       total_bytes("bytes").alias("total_bytes"),
                       F.sum("is_error").alias("error_count")))
    return (per_ip
            .withColumn("error_rate",
                        F.round(F.col("error_count") / F.col("request_count") * 100, 2)))


def top_ips(logs: DataFrame, top_n: int = 20, edges: DataFrame | None = None) -> DataFrame:
    """A4."""
    return ip_activity(logs, edges).orderBy(F.desc("request_count"), F.asc("ip")).limit(top_n)


def http_status(logs: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """By (status, status_category); from ``minute_rollup`` when given."""
    if rollup is not None:
        return rollup.groupBy("status", "status_category").agg(F.sum("n").alias("count"))
    return logs.groupBy("status", "status_category").agg(F.count(F.lit(1)).alias("count"))


def http_status_summary(logs: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """By status_category; from ``minute_rollup`` when given."""
    if rollup is not None:
        return rollup.groupBy("status_category").agg(F.sum("n").alias("count"))
    return logs.groupBy("status_category").agg(F.count(F.lit(1)).alias("count"))


def errors(logs: DataFrame) -> DataFrame:
    """Status >= 400 by (status, url); the filter runs before the shuffle."""
    return (logs.filter(F.col("status") >= 400)
            .groupBy("status", "url")
            .agg(F.count(F.lit(1)).alias("error_count"),
                 F.countDistinct("ip").alias("affected_ips")))


def traffic_volume(logs: DataFrame, window: str = "10 minutes", clients: DataFrame | None = None) -> DataFrame:
    """Tumbling windows on the timestamp (rows with NULL timestamp have no window).

    From ``minute_client_rollup`` when given: whole-minute windows hold whole minutes.
    """
    if clients is not None:
        agg = _client_rollup_aggs()
        return (clients.groupBy(F.window("minute_ts", window).alias("w"))
                .agg(agg[0].alias("request_count"), agg[2], agg[1], agg[3])
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "request_count", "total_bytes", "unique_ips", "avg_bytes"))
    return (logs.groupBy(F.window("timestamp", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("request_count"),
                 total_bytes("bytes").alias("total_bytes"),
                 F.countDistinct("ip").alias("unique_ips"),
                 F.avg("bytes").alias("avg_bytes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "request_count", "total_bytes", "unique_ips", "avg_bytes"))


def peaks(logs: DataFrame, threshold_percentile: float = 0.95, exact: bool = True,
          rollup: DataFrame | None = None) -> DataFrame:
    """Minutes whose request count is strictly above the percentile of all minutes.

    The threshold is a one-row aggregate over the per-minute table (one row per
    minute of the time range, not per log line) joined back by a broadcast of
    that single row; nothing goes through the driver.
    """
    per_minute = per_minute_counts(logs, rollup)
    return peaks_above(per_minute, percentile_threshold(per_minute, "access_count", threshold_percentile, exact))


def peaks_above(per_minute: DataFrame, threshold: DataFrame) -> DataFrame:
    """The minutes strictly above a one-row ``threshold``."""
    return (per_minute.crossJoin(one_row_broadcast(threshold))
            .filter(F.col("access_count") > F.col("threshold"))
            .drop("threshold"))


def shared_tables(logs: DataFrame) -> dict[str, DataFrame]:
    """The three tables that the KPIs re-aggregate, stored: one scan of the logs for each."""
    edges = logs.groupBy("ip", "url").agg(
        F.count(F.lit(1)).alias("weight"), total_bytes("bytes").alias("total_bytes"),
        F.sum("is_error").alias("error_count")).withColumnsRenamed({"ip": "src", "url": "dst"})
    return {"rollup": stored(minute_rollup(logs), "kpi-rollup"), "edges": stored(edges, "kpi-edges"),
            "clients": stored(minute_client_rollup(logs), "kpi-clients")}


def all_kpis(logs: DataFrame, rollup: DataFrame | None = None,
             edges: DataFrame | None = None, clients: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every KPI table, lazily (nothing runs until a sink or action).

    ``rollup`` (``minute_rollup``), ``edges`` (``graph.graph_edges``) and
    ``clients`` (``minute_client_rollup``) are optional shared inputs a batch
    run builds once."""
    return {
        "access_per_hour": access_per_hour(logs, clients),
        "access_per_minute": access_per_minute(logs, clients),
        "top_urls": top_urls(logs, edges=edges),
        "top_ips": top_ips(logs, edges=edges),
        "http_status": http_status(logs, rollup),
        "errors": errors(logs),
        "traffic_volume": traffic_volume(logs, clients=clients),
        "peaks": peaks(logs, rollup=rollup),
    }


def kpi_row_counts(kpis: dict[str, DataFrame]) -> DataFrame:
    """Row count of each KPI, as one small table (one aggregate per KPI, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("kpi"), "row_count")
             for name, df in kpis.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def global_totals(logs: DataFrame) -> DataFrame:
    """Total requests, distinct ips, total bytes."""
    return logs.agg(F.count(F.lit(1)).alias("total_requests"),
                    F.countDistinct("ip").alias("unique_ips"),
                    total_bytes("bytes").alias("total_bytes"))


# A10: the documented SQL forms, run through Spark SQL over the ``logs`` view.
# users' documented queries must stay as they are.
SQL_ACCESS_PER_HOUR = """
SELECT date, hour, COUNT(*) AS access_count, COUNT(DISTINCT ip) AS unique_ips
FROM {view}
GROUP BY date, hour
"""

SQL_TOP_URLS = """
SELECT url, COUNT(*) AS hit_count, COUNT(DISTINCT ip) AS unique_visitors
FROM {view}
GROUP BY url
ORDER BY hit_count DESC, url ASC
LIMIT 20
"""

SQL_ERRORS = """
SELECT status, url, COUNT(*) AS error_count
FROM {view}
WHERE status >= 400
GROUP BY status, url
"""


def register_view(logs: DataFrame, view_name: str = "logs") -> str:
    """Expose the logs table to ``spark.sql``."""
    logs.createOrReplaceTempView(view_name)
    return view_name


def sql_over_view(logs: DataFrame, query: str, view_name: str = "logs") -> DataFrame:
    """A10: run one of the SQL texts above against a temp view of ``logs``."""
    register_view(logs, view_name)
    return logs.sparkSession.sql(query.format(view=view_name))
