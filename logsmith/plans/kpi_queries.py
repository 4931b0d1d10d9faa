"""Registered queries: KPI tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsmith.operators import kpis, summaries
from logsmith.operators.common import RANK_ERROR, one_row_broadcast
from logsmith.plans.oracle import with_logs
from logsmith.plans.registry import logs_table, register
from logsmith.scratch import stored


@register("access_per_hour", "A1", with_logs("""
SELECT date, hour, count(*) AS access_count, count(DISTINCT ip) AS unique_ips,
       CAST(sum(bytes) AS BIGINT) AS total_bytes, round(avg(bytes), 6) AS avg_bytes
FROM logs GROUP BY date, hour"""))
def access_per_hour(spark, sf_dir):
    return kpis.access_per_hour(logs_table(spark, sf_dir))


@register("access_per_minute", "A2", with_logs("""
SELECT minute, count(*) AS access_count, count(DISTINCT ip) AS unique_ips
FROM logs GROUP BY minute"""))
def access_per_minute(spark, sf_dir):
    return kpis.access_per_minute(logs_table(spark, sf_dir))


TOP_URLS_SQL = """
SELECT url, count(*) AS hit_count, count(DISTINCT ip) AS unique_visitors,
       CAST(sum(bytes) AS BIGINT) AS total_bytes
FROM logs GROUP BY url ORDER BY hit_count DESC, url ASC LIMIT 20"""


@register("top_urls", "A3", with_logs(TOP_URLS_SQL))
def top_urls(spark, sf_dir):
    return kpis.top_urls(logs_table(spark, sf_dir))


IP_ACTIVITY_SQL = """
SELECT ip, count(*) AS request_count, count(DISTINCT url) AS unique_urls,
       CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(is_error) AS BIGINT) AS error_count,
       round(CAST(sum(is_error) AS DOUBLE) / count(*) * 100, 2) AS error_rate
FROM logs GROUP BY ip"""


@register("top_ips", "A4", with_logs(
    f"SELECT * FROM ({IP_ACTIVITY_SQL}) ORDER BY request_count DESC, ip ASC LIMIT 20"))
def top_ips(spark, sf_dir):
    return kpis.top_ips(logs_table(spark, sf_dir))


@register("http_status", "A5a", with_logs("""
SELECT status, status_category, count(*) AS count FROM logs GROUP BY status, status_category"""))
def http_status(spark, sf_dir):
    return kpis.http_status(logs_table(spark, sf_dir))


@register("http_status_summary", "A5b", with_logs("""
SELECT status_category, count(*) AS count FROM logs GROUP BY status_category"""))
def http_status_summary(spark, sf_dir):
    return kpis.http_status_summary(logs_table(spark, sf_dir))


@register("errors", "A6 P10", with_logs("""
SELECT status, url, count(*) AS error_count, count(DISTINCT ip) AS affected_ips
FROM logs WHERE status >= 400 GROUP BY status, url"""))
def errors(spark, sf_dir):
    return kpis.errors(logs_table(spark, sf_dir))


TRAFFIC_SQL = """
SELECT time_bucket(INTERVAL '10 minutes', "timestamp") AS window_start,
       time_bucket(INTERVAL '10 minutes', "timestamp") + INTERVAL '10 minutes' AS window_end,
       count(*) AS request_count, CAST(sum(bytes) AS BIGINT) AS total_bytes,
       count(DISTINCT ip) AS unique_ips, round(avg(bytes), 6) AS avg_bytes
FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1, 2"""


@register("traffic_volume", "A7", with_logs(TRAFFIC_SQL))
def traffic_volume(spark, sf_dir):
    return kpis.traffic_volume(logs_table(spark, sf_dir))


PEAKS_SQL = """
SELECT minute, access_count FROM per_minute
WHERE access_count > (SELECT percentile_disc(0.95) WITHIN GROUP (ORDER BY access_count) FROM per_minute)"""
PER_MINUTE_CTE = "per_minute AS (SELECT minute, count(*) AS access_count FROM logs GROUP BY minute)"


@register("peaks", "A8", with_logs(PEAKS_SQL, PER_MINUTE_CTE))
def peaks(spark, sf_dir):
    return kpis.peaks(logs_table(spark, sf_dir))


@register("peaks_approx", "A8 (approximate mode)", with_logs("""
SELECT count(*) AS minutes, true AS rank_within_error, true AS peaks_follow_threshold FROM per_minute""", PER_MINUTE_CTE))
def peaks_approx(spark, sf_dir):
    """The percentile from merged hourly sketches: its true rank, and the peaks that follow from it."""
    per_minute = stored(kpis.per_minute_counts(logs_table(spark, sf_dir)), "peaks-minutes")
    hourly = stored(summaries.hourly_rank_sketches(per_minute), "peaks-sketches")
    threshold = stored(summaries.merged_threshold(hourly, 0.95), "peaks-threshold")
    found = kpis.peaks_above(per_minute, threshold).agg(F.count(F.lit(1)).alias("peaks"))
    ranks = per_minute.crossJoin(one_row_broadcast(threshold)).agg(
        F.count(F.lit(1)).alias("minutes"), F.avg((F.col("access_count") < F.col("threshold")).cast("double")).alias("below"),
        F.avg((F.col("access_count") <= F.col("threshold")).cast("double")).alias("up_to"),
        F.sum((F.col("access_count") > F.col("threshold")).cast("long")).alias("above"))
    return ranks.crossJoin(one_row_broadcast(found)).select(
        "minutes", ((F.col("below") <= 0.95 + RANK_ERROR) & (F.col("up_to") >= 0.95 - RANK_ERROR)).alias("rank_within_error"),
        (F.col("peaks") == F.col("above")).alias("peaks_follow_threshold"))


#: Capacities that make the summaries of the test log cut at every level.
_SMALL = {"hour": 10, "day": 40, None: 100}


def _merged_summary(logs, key: str, capacities: dict):
    hourly = stored(summaries.item_summaries(logs, key, "hour", capacities["hour"]), "hitters-hourly")
    daily = stored(summaries.merge_summaries(hourly, "day", capacities["day"]), "hitters-daily")
    return stored(summaries.merge_summaries(daily, None, capacities[None]), "hitters-all")


_LARGE = {"hour": 1000, "day": 1000, None: 1000}


@register("heavy_hitter_urls", "A3 (long ranges)", with_logs(TOP_URLS_SQL))
def heavy_hitter_urls(spark, sf_dir):
    """The top urls through hourly summaries merged to days and to the whole range, then one scan of candidates."""
    logs = stored(logs_table(spark, sf_dir), "hitters-logs")
    return summaries.exact_top(logs, _merged_summary(logs, "url", _LARGE), "url", 20, kpis.top_urls)


@register("heavy_hitter_ips", "A4 (long ranges)", with_logs(
    f"SELECT * FROM ({IP_ACTIVITY_SQL}) ORDER BY request_count DESC, ip ASC LIMIT 20"))
def heavy_hitter_ips(spark, sf_dir):
    logs = stored(logs_table(spark, sf_dir), "hitters-logs")
    return summaries.exact_top(logs, _merged_summary(logs, "ip", _SMALL), "ip", 20, kpis.top_ips)


@register("heavy_hitter_bounds", "A3 (long ranges)", with_logs("""
SELECT least(count(DISTINCT url), 100) AS kept, CAST(0 AS BIGINT) AS outside_bounds, CAST(0 AS BIGINT) AS missed_too_large
FROM logs"""))
def heavy_hitter_bounds(spark, sf_dir):
    """Summaries that were cut at every level: every item's exact count is inside its bounds."""
    logs = stored(logs_table(spark, sf_dir), "hitters-logs")
    summary = _merged_summary(logs, "url", _SMALL)
    exact = logs.groupBy(F.col("url").alias("item")).agg(F.count(F.lit(1)).alias("exact"))
    missed = summary.agg(F.max("missed").alias("bound"))
    checked = exact.join(summary, "item", "left").crossJoin(one_row_broadcast(missed))
    outside = (F.col("exact") < F.col("n")) | (F.col("exact") > F.col("n") + F.col("error"))
    return checked.agg(
        F.count("n").alias("kept"), F.sum(F.when(F.col("n").isNotNull() & outside, 1).otherwise(0)).alias("outside_bounds"),
        F.sum(F.when(F.col("n").isNull() & (F.col("exact") > F.col("bound")), 1).otherwise(0)).alias("missed_too_large"))


_KPI_COUNT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS kpi, count(*) AS row_count FROM ({body})"
    for name, body in [
        ("access_per_hour", "SELECT date, hour FROM logs GROUP BY date, hour"),
        ("access_per_minute", "SELECT minute FROM logs GROUP BY minute"),
        ("top_urls", "SELECT url FROM logs GROUP BY url LIMIT 20"),
        ("top_ips", "SELECT ip FROM logs GROUP BY ip LIMIT 20"),
        ("http_status", "SELECT status, status_category FROM logs GROUP BY 1, 2"),
        ("errors", "SELECT status, url FROM logs WHERE status >= 400 GROUP BY 1, 2"),
        ("traffic_volume", 'SELECT time_bucket(INTERVAL \'10 minutes\', "timestamp") FROM logs '
                           'WHERE "timestamp" IS NOT NULL GROUP BY 1'),
        ("peaks", PEAKS_SQL),
    ])


@register("kpi_row_counts", "A9", with_logs(_KPI_COUNT_SQL, PER_MINUTE_CTE))
def kpi_row_counts(spark, sf_dir):
    logs = logs_table(spark, sf_dir)
    return kpis.kpi_row_counts(kpis.all_kpis(logs, **kpis.shared_tables(logs)))


@register("global_totals", "A11", with_logs("""
SELECT count(*) AS total_requests, count(DISTINCT ip) AS unique_ips,
       CAST(sum(bytes) AS BIGINT) AS total_bytes FROM logs"""))
def global_totals(spark, sf_dir):
    return kpis.global_totals(logs_table(spark, sf_dir))


@register("sql_access_per_hour", "A10 S12", with_logs("""
SELECT date, hour, count(*) AS access_count, count(DISTINCT ip) AS unique_ips
FROM logs GROUP BY date, hour"""))
def sql_access_per_hour(spark, sf_dir):
    return kpis.sql_over_view(logs_table(spark, sf_dir), kpis.SQL_ACCESS_PER_HOUR)


@register("sql_top_urls", "A10 S12", with_logs("""
SELECT url, count(*) AS hit_count, count(DISTINCT ip) AS unique_visitors
FROM logs GROUP BY url ORDER BY hit_count DESC, url ASC LIMIT 20"""))
def sql_top_urls(spark, sf_dir):
    return kpis.sql_over_view(logs_table(spark, sf_dir), kpis.SQL_TOP_URLS)


@register("sql_errors", "A10 S12", with_logs("""
SELECT status, url, count(*) AS error_count FROM logs WHERE status >= 400 GROUP BY status, url"""))
def sql_errors(spark, sf_dir):
    return kpis.sql_over_view(logs_table(spark, sf_dir), kpis.SQL_ERRORS)


# The dashboard's status panel query, as documented, over a view of the KPI table.
PANEL_STATUS_SQL = "SELECT status_category, count FROM {view}"


@register("sql_over_view", "S12 A10 (dashboard SQL over a KPI view)", with_logs("""
SELECT status_category, count FROM (
  SELECT status, status_category, count(*) AS count FROM logs GROUP BY status, status_category)"""))
def sql_over_view(spark, sf_dir):
    """A KPI table registered as a view and queried with the dashboard's SQL text."""
    return kpis.sql_over_view(kpis.http_status(logs_table(spark, sf_dir)), PANEL_STATUS_SQL,
                              view_name="http_status")
