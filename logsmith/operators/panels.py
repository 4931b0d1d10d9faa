"""Dashboard panels and alert rules (D1-D7) as tables.

The alert rules hold "for N minutes": a minute fires when it and the N-1
calendar minutes before it all breach.  Instead of a window ordered over the
whole minute axis (one task), each breaching minute is expanded to the N
minutes it supports and the supports are counted per minute, a shuffle-
partitioned aggregation; minutes without traffic never breach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsmith.functions.logline import minute_of
from logsmith.operators.common import one_row_broadcast, percentile_threshold
from logsmith.scratch import stored


def overview(logs: DataFrame) -> DataFrame:
    """Totals of the overview dashboard, one row."""
    # one scan: requests per (minute, client), re-aggregated three ways
    cells = stored(logs.groupBy(minute_of(F.col("timestamp")).alias("minute"), "ip").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_error").alias("errors")), "overview-cells")
    totals = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_requests"),
                       F.countDistinct("ip").alias("unique_ips"),
                       F.sum("errors").alias("error_count"))
    per_minute = cells.filter(F.col("minute").isNotNull()).groupBy("minute").agg(F.sum("n").alias("n"))
    minutes = per_minute.agg(
        F.count(F.lit(1)).alias("active_minutes"), F.avg("n").alias("avg_requests_per_minute"))
    return (totals.crossJoin(minutes)
            .withColumn("error_rate", F.try_divide(F.col("error_count").cast("double"), F.col("total_requests"))))


def status_share(logs: DataFrame) -> DataFrame:
    """Requests per status category and their percentage share."""
    counts = logs.groupBy("status_category").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    return (counts.crossJoin(one_row_broadcast(total))
            .withColumn("share_pct", F.round(F.col("count") * 100.0 / F.col("total"), 2))
            .drop("total"))


def score_histogram(scores: DataFrame, score_col: str = "max_z_score", width: float = 0.5) -> DataFrame:
    """D3: histogram of anomaly scores in buckets of ``width``; a NULL score has the NULL bucket."""
    bucket = F.floor(F.col(score_col) / width).cast("int")
    return (scores.groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bucket_start", F.col("bucket") * F.lit(width)))


def error_heatmap(logs: DataFrame) -> DataFrame:
    """D3: errors by hour of day and status."""
    return (logs.filter(F.col("is_error") == 1)
            .groupBy("hour", "status").agg(F.count(F.lit(1)).alias("count")))


def ip_url_heatmap(edges: DataFrame, top_ips: int = 10, top_urls: int = 10) -> DataFrame:
    """Edge weights between the busiest clients and the most hit urls.

    Requests of a client or url are the summed weights of its edges, so the logs are scanned
    once, for the edge table.  Both top-k sets have at most k rows, so both semi-joins
    broadcast them.
    """
    edges = stored(edges.select("src", "dst", "weight"), "heatmap-edges")

    def top(key: str, k: int) -> DataFrame:
        return (edges.groupBy(key).agg(F.sum("weight").alias("n"))
                .orderBy(F.desc("n"), F.asc(key)).limit(k).select(key))

    ips, urls = top("src", top_ips), top("dst", top_urls)
    return (edges.join(F.broadcast(ips), on="src", how="left_semi")
            .join(F.broadcast(urls), on="dst", how="left_semi")
            .select("src", "dst", "weight"))


def _sustained(per_minute: DataFrame, breach_col: str, for_minutes: int) -> DataFrame:
    """Minutes whose own and ``for_minutes - 1`` previous minutes all breach."""
    supports = (per_minute.filter(F.col(breach_col))
                .select(F.explode(F.sequence(
                    F.col("minute_ts"),
                    F.col("minute_ts") + F.make_dt_interval(mins=F.lit(for_minutes - 1)),
                    F.make_dt_interval(mins=F.lit(1)))).alias("minute_ts"))
                .groupBy("minute_ts").agg(F.count(F.lit(1)).alias("supports")))
    return (per_minute.join(supports, on="minute_ts", how="left")
            .withColumn("firing", F.coalesce(F.col("supports") == for_minutes, F.lit(False)).cast("int"))
            .drop("supports"))


def _per_minute(logs: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    if rollup is not None:
        return (rollup.filter(F.col("minute_ts").isNotNull()).groupBy("minute_ts")
                .agg(F.sum("n").alias("request_count"),
                     F.sum(F.col("n") * F.col("is_error")).alias("error_count")))
    return (logs.filter(F.col("timestamp").isNotNull())
            .groupBy(F.date_trunc("minute", F.col("timestamp")).alias("minute_ts"))
            .agg(F.count(F.lit(1)).alias("request_count"), F.sum("is_error").alias("error_count")))


def alert_error_rate(logs: DataFrame, max_error_rate: float = 0.10, for_minutes: int = 5,
                     rollup: DataFrame | None = None) -> DataFrame:
    """Error rate above ``max_error_rate`` for ``for_minutes`` consecutive minutes."""
    pm = _per_minute(logs, rollup).withColumn("error_rate", F.col("error_count") / F.col("request_count"))
    pm = pm.withColumn("breach", F.col("error_rate") > max_error_rate)
    return (_sustained(pm, "breach", for_minutes)
            .select(minute_of(F.col("minute_ts")).alias("minute"), "request_count", "error_count",
                    "error_rate", F.col("breach").cast("int").alias("breach"), "firing"))


def alert_traffic_spike(logs: DataFrame, threshold: float | None = None, percentile: float = 0.95,
                        for_minutes: int = 5) -> DataFrame:
    """Requests per minute above a threshold for ``for_minutes`` consecutive minutes.

    Without an explicit ``threshold`` the percentile of per-minute counts is used
    (the same data-derived level as the peak detector).
    """
    pm = _per_minute(logs)
    if threshold is None:
        pm = pm.crossJoin(one_row_broadcast(percentile_threshold(pm, "request_count", percentile)))
    else:
        pm = pm.withColumn("threshold", F.lit(float(threshold)))
    pm = pm.withColumn("breach", F.col("request_count") > F.col("threshold"))
    return (_sustained(pm, "breach", for_minutes)
            .select(minute_of(F.col("minute_ts")).alias("minute"), "request_count", "threshold",
                    F.col("breach").cast("int").alias("breach"), "firing"))


def alert_anomaly(anomalies: DataFrame, max_anomalous: int = 5) -> DataFrame:
    """Anomalous client count above ``max_anomalous`` (one row)."""
    return (anomalies.agg(F.coalesce(F.sum("is_anomaly"), F.lit(0)).cast("bigint").alias("anomalous_ips"))
            .withColumn("threshold", F.lit(max_anomalous))
            .withColumn("firing", (F.col("anomalous_ips") > max_anomalous).cast("int")))
