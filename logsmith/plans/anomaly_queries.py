"""Registered queries: features, z-scores, K-Means family, behaviour, rule labels."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.operators import lloyd as L
from logsmith.operators.parsing import describe_columns
from logsmith.plans.oracle import with_logs
from logsmith.plans.parse_queries import LOG_SELECT, _describe_sql
from logsmith.plans.registry import logs_table, register
from logsmith.scratch import stored

FEATURES_CTE = """feat AS (
  SELECT ip, count(*) AS request_count, count(DISTINCT url) AS unique_urls,
         count(DISTINCT date) AS active_days, CAST(sum(bytes) AS BIGINT) AS total_bytes,
         avg(bytes) AS avg_bytes, CAST(sum(is_error) AS BIGINT) AS error_count,
         count(DISTINCT hour) AS active_hours,
         CAST(sum(is_error) AS DOUBLE) / count(*) AS error_rate,
         CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT date), 0) AS requests_per_day,
         CAST(sum(bytes) AS DOUBLE) / count(*) AS bytes_per_request,
         CAST(count(DISTINCT url) AS DOUBLE) / count(*) AS urls_per_request
  FROM logs GROUP BY ip)"""

ZSCORE_CTES = FEATURES_CTE + """,
stats AS (
  SELECT avg(request_count) AS m_r, stddev_samp(request_count) AS s_r,
         avg(error_rate) AS m_e, stddev_samp(error_rate) AS s_e,
         avg(bytes_per_request) AS m_b, stddev_samp(bytes_per_request) AS s_b FROM feat),
zs AS (
  SELECT feat.*, (request_count - m_r) / nullif(s_r, 0) AS z_score_requests,
         (error_rate - m_e) / nullif(s_e, 0) AS z_score_error_rate,
         (bytes_per_request - m_b) / nullif(s_b, 0) AS z_score_bytes
  FROM feat CROSS JOIN stats),
flagged AS (
  SELECT *, CASE WHEN abs(z_score_requests) > 3.0 OR abs(z_score_error_rate) > 3.0
                      OR abs(z_score_bytes) > 3.0 THEN 1 ELSE 0 END AS is_anomaly,
         greatest(abs(z_score_requests), abs(z_score_error_rate), abs(z_score_bytes)) AS max_z_score
  FROM zs)"""

FEATURE_DOUBLES = ["avg_bytes", "error_rate", "requests_per_day", "bytes_per_request", "urls_per_request"]


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


FEATURE_SELECT = ("ip, request_count, unique_urls, active_days, total_bytes, error_count, active_hours, "
                  + _r(FEATURE_DOUBLES))


def features_of(spark, sf_dir):
    return A.client_features(logs_table(spark, sf_dir))


def zscores_of(spark, sf_dir):
    return A.zscore_anomalies(features_of(spark, sf_dir))


@register("client_features", "M1", with_logs(f"SELECT {FEATURE_SELECT} FROM feat", FEATURES_CTE))
def client_features(spark, sf_dir):
    return features_of(spark, sf_dir)


@register("describe_features", "P9", with_logs(_describe_sql("feat", A.FEATURE_COLUMNS), FEATURES_CTE))
def describe_features(spark, sf_dir):
    return describe_columns(features_of(spark, sf_dir), A.FEATURE_COLUMNS)


@register("zscore_anomalies", "M9", with_logs(
    f"SELECT {FEATURE_SELECT}, "
    + _r(["z_score_requests", "z_score_error_rate", "z_score_bytes", "max_z_score"])
    + ", is_anomaly FROM flagged", ZSCORE_CTES))
def zscore_anomalies(spark, sf_dir):
    return zscores_of(spark, sf_dir)


@register("suspicious_ips_stat", "M10", with_logs("""
SELECT ip, request_count, unique_urls, error_count, round(error_rate, 6) AS error_rate, total_bytes,
       round(max_z_score, 6) AS anomaly_score
FROM flagged WHERE is_anomaly = 1 ORDER BY max_z_score DESC, ip ASC LIMIT 50""", ZSCORE_CTES))
def suspicious_ips_stat(spark, sf_dir):
    return A.suspicious_ips(zscores_of(spark, sf_dir), score_col="max_z_score")


def _anomalous(spark, sf_dir):
    logs = logs_table(spark, sf_dir)
    return A.anomalous_requests(logs, A.zscore_anomalies(A.client_features(logs)))


FLAGGED_LOGS_CTE = ZSCORE_CTES + """,
flagged_logs AS (SELECT * FROM logs WHERE ip IN (SELECT ip FROM flagged WHERE is_anomaly = 1))"""


@register("anomalous_requests", "M11", with_logs(f"SELECT {LOG_SELECT} FROM flagged_logs", FLAGGED_LOGS_CTE))
def anomalous_requests(spark, sf_dir):
    return _anomalous(spark, sf_dir)


@register("anomalous_top_urls", "M11", with_logs(
    "SELECT url, count(*) AS count FROM flagged_logs GROUP BY url ORDER BY count DESC, url ASC LIMIT 10",
    FLAGGED_LOGS_CTE))
def anomalous_top_urls(spark, sf_dir):
    return A.anomalous_top_urls(_anomalous(spark, sf_dir))


@register("anomalous_by_hour", "M11", with_logs(
    "SELECT hour, count(*) AS count FROM flagged_logs GROUP BY hour", FLAGGED_LOGS_CTE))
def anomalous_by_hour(spark, sf_dir):
    return A.anomalous_by_hour(_anomalous(spark, sf_dir))


@register("anomalous_error_codes", "M11", with_logs(
    "SELECT status, count(*) AS count FROM flagged_logs WHERE is_error = 1 GROUP BY status",
    FLAGGED_LOGS_CTE))
def anomalous_error_codes(spark, sf_dir):
    return A.anomalous_error_codes(_anomalous(spark, sf_dir))


# ----------------------------------------------------------------------------- K-Means

def _fitted(spark, sf_dir, k: int = 5):
    # one row per client, written once as a reliable checkpoint: the K-Means
    # iterations re-read it, and a lost executor does not send them back to the raw logs
    feats = A.kmeans_input(features_of(spark, sf_dir)).checkpoint(eager=True)
    model = A.fit_kmeans(feats, k=k)
    return model, model.transform(feats)


_SCALED_CTES = FEATURES_CTE + ",\nkin AS (SELECT * REPLACE (coalesce(requests_per_day, 0.0) AS requests_per_day) FROM feat),\n" + \
    "kstats AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in A.KMEANS_FEATURES) + " FROM kin)"


@register("scaled_features", "M2 M3", with_logs(
    "SELECT ip, " + ", ".join(
        f"round(CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END, 6) AS scaled_{c}"
        for c in A.KMEANS_FEATURES) + " FROM kin CROSS JOIN kstats", _SCALED_CTES))
def scaled_features(spark, sf_dir):
    """Assembler + scaler stages of the fitted pipeline, the vector unpacked into columns."""
    model, pred = _fitted(spark, sf_dir)
    arr = vector_to_array(F.col("features"))
    return pred.select("ip", *[arr[i].alias(f"scaled_{c}") for i, c in enumerate(A.KMEANS_FEATURES)])


STEPS, CLUSTERS = 20, 5


def _lloyd_ctes() -> str:
    """K-Means as DuckDB text: farthest-first seeds and STEPS Lloyd steps, one table each."""
    columns = A.KMEANS_FEATURES
    value = {c: f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in columns}
    ctes = [FEATURES_CTE,
            "kst AS (SELECT " + ", ".join(f"avg({v}) AS m_{c}, stddev_samp({v}) AS s_{c}" for c, v in value.items()) + " FROM feat)",
            "pts AS MATERIALIZED (SELECT ip, [" + ", ".join(
                f"CASE WHEN s_{c} > 0 THEN round(({v} - m_{c}) / s_{c}, {L.PLACES}) ELSE 0.0 END + 0.0" for c, v in value.items())
            + "] AS x FROM feat, kst)",
            "seed_1 AS MATERIALIZED (SELECT x FROM pts ORDER BY ip LIMIT 1)",
            "far_1 AS MATERIALIZED (SELECT ip, p.x, list_distance(p.x, s.x) AS d FROM pts p, seed_1 s)"]
    for i in range(2, CLUSTERS + 1):
        ctes += [f"seed_{i} AS MATERIALIZED (SELECT x FROM far_{i - 1} ORDER BY d DESC, ip LIMIT 1)",
                 f"far_{i} AS MATERIALIZED (SELECT ip, f.x, least(d, list_distance(f.x, s.x)) AS d FROM far_{i - 1} f, seed_{i} s)"]
    ctes.append("cen_0 AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT {i - 1} AS no, x FROM seed_{i}" for i in range(1, CLUSTERS + 1)) + ")")
    for i in range(STEPS + 1):
        ctes.append(f"""asg_{i} AS MATERIALIZED (SELECT ip, x, no, d FROM (
  SELECT p.ip, p.x, c.no, list_distance(p.x, c.x) AS d,
         row_number() OVER (PARTITION BY p.ip ORDER BY list_distance(p.x, c.x), c.no) AS place
  FROM pts p, cen_{i} c) WHERE place = 1)""")
        if i < STEPS:
            ctes.append(f"""cen_{i + 1} AS MATERIALIZED (SELECT c.no, coalesce(m.x, c.x) AS x FROM cen_{i} c LEFT JOIN (
  SELECT no, list(v ORDER BY j) AS x FROM (
    SELECT no, j, avg(x[j]) AS v FROM asg_{i}, range(1, {len(columns) + 1}) AS t(j) GROUP BY no, j) GROUP BY no) m USING (no))""")
    ctes.append(f"""clustered AS MATERIALIZED (
  SELECT ip, x, CAST(no AS INTEGER) AS cluster, d AS centroid_distance,
         count(*) OVER (PARTITION BY no) AS cluster_size FROM asg_{STEPS})""")
    ctes.append("""scored AS MATERIALIZED (
  SELECT *, 1.0 / cluster_size AS anomaly_score,
         CASE WHEN 1.0 / cluster_size > (SELECT percentile_disc(0.95) WITHIN GROUP (ORDER BY 1.0 / cluster_size) FROM clustered)
              THEN 1 ELSE 0 END AS is_anomaly FROM clustered)""")
    ctes.append(f"""moments AS MATERIALIZED (
  SELECT no, n, q, s FROM (SELECT cluster AS no, count(*) AS n, sum(list_inner_product(x, x)) AS q FROM clustered GROUP BY 1)
  JOIN (SELECT no, list(v ORDER BY j) AS s FROM (SELECT cluster AS no, j, sum(x[j]) AS v
        FROM clustered, range(1, {len(columns) + 1}) AS t(j) GROUP BY ALL) GROUP BY no) USING (no))""")
    return ",\n".join(ctes)


LLOYD_CTES = _lloyd_ctes()


def _clustered(spark, sf_dir):
    """Clients with their cluster by deterministic K-Means; the scaled table is stored, as every step reads it."""
    scaled = stored(L.scaled_features(features_of(spark, sf_dir), A.KMEANS_FEATURES), "kmeans-scaled")
    return L.fit(scaled, CLUSTERS, STEPS).assign(scaled)


@register("kmeans_clusters", "M4", with_logs("SELECT ip, cluster FROM clustered", LLOYD_CTES))
def kmeans_clusters(spark, sf_dir):
    return _clustered(spark, sf_dir).select("ip", "cluster")


@register("cluster_sizes", "M6", with_logs(
    "SELECT cluster, count(*) AS cluster_size FROM clustered GROUP BY cluster", LLOYD_CTES))
def cluster_sizes(spark, sf_dir):
    return A.cluster_sizes(_clustered(spark, sf_dir))


@register("kmeans_quality", "M5 M13", with_logs(f"""
SELECT {CLUSTERS} AS k, round((SELECT sum(q - list_inner_product(s, s) / n) FROM moments), 6) AS training_cost,
       round(avg(CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM (SELECT ip, max(n) FILTER (no = cluster) AS own_n, max(away / greatest(n - 1, 1)) FILTER (no = cluster) AS a,
             min(away / n) FILTER (no <> cluster) AS b
      FROM (SELECT ip, cluster, no, n, n * list_inner_product(x, x) + q - 2 * list_inner_product(x, s) AS away
            FROM clustered, moments) GROUP BY ip)""", LLOYD_CTES))
def kmeans_quality(spark, sf_dir):
    return L.quality(_clustered(spark, sf_dir), CLUSTERS)


@register("kmeans_anomalies", "M7 M8", with_logs(f"""
SELECT {FEATURE_SELECT}, cluster, cluster_size, round(anomaly_score, 6) AS anomaly_score, is_anomaly
FROM scored JOIN feat USING (ip)""", LLOYD_CTES))
def kmeans_anomalies(spark, sf_dir):
    return A.kmeans_anomalies(_clustered(spark, sf_dir)).drop("features", "centroid_distance")


@register("suspicious_ips", "M10", with_logs("""
SELECT ip, request_count, unique_urls, error_count, round(error_rate, 6) AS error_rate, total_bytes,
       round(anomaly_score, 6) AS anomaly_score
FROM scored JOIN feat USING (ip) WHERE is_anomaly = 1 ORDER BY scored.anomaly_score DESC, ip ASC LIMIT 50""", LLOYD_CTES))
def suspicious_ips(spark, sf_dir):
    return A.suspicious_ips(A.kmeans_anomalies(_clustered(spark, sf_dir)))


@register("centroid_distance", "M12", with_logs(
    "SELECT ip, cluster, round(centroid_distance, 6) AS centroid_distance FROM clustered", LLOYD_CTES))
def centroid_distance(spark, sf_dir):
    return _clustered(spark, sf_dir).select("ip", "cluster", "centroid_distance")


# ----------------------------------------------------------------------------- rules

EDGES_CTE = """edges AS (
  SELECT ip AS src, url AS dst, count(*) AS weight, CAST(sum(bytes) AS BIGINT) AS total_bytes,
         CAST(sum(is_error) AS BIGINT) AS error_count
  FROM logs GROUP BY ip, url)"""

RULES_SQL = """
SELECT f.ip, f.request_count, round(f.requests_per_day, 6) AS requests_per_day, f.unique_urls,
       round(f.error_rate, 6) AS error_rate, coalesce(a.attack_edges, 0) AS attack_edges,
       CAST(coalesce(f.requests_per_day > 10000, false) OR f.unique_urls > 500 AS INTEGER) AS is_scraper,
       CAST(coalesce(f.error_rate > 0.5, false) AS INTEGER) AS is_attacker,
       CAST(f.unique_urls > 500 AS INTEGER) AS is_bot,
       CAST(coalesce(a.attack_edges, 0) > 0 AS INTEGER) AS has_attack_edge,
       coalesce(nullif(concat_ws(',',
           CASE WHEN coalesce(f.requests_per_day > 10000, false) OR f.unique_urls > 500 THEN 'scraper' END,
           CASE WHEN coalesce(f.error_rate > 0.5, false) THEN 'attacker' END,
           CASE WHEN f.unique_urls > 500 THEN 'bot' END,
           CASE WHEN coalesce(a.attack_edges, 0) > 0 THEN 'attack_edge' END), ''), 'normal') AS labels
FROM feat f LEFT JOIN attack a ON f.ip = a.ip"""


@register("rule_labels", "M14", with_logs(RULES_SQL, FEATURES_CTE + ",\n" + EDGES_CTE + """,
attack AS (SELECT src AS ip, count(*) AS attack_edges FROM edges
           WHERE CAST(error_count AS DOUBLE) / weight > 0.5 GROUP BY src)"""))
def rule_labels(spark, sf_dir):
    logs = logs_table(spark, sf_dir)
    return A.rule_labels(A.client_features(logs), G.graph_edges(logs))


@register("kmeans_invariants", "M4 M5 M6 M7 M8 M12 M13 (library K-Means)", with_logs("""
SELECT count(DISTINCT ip) AS clients, CAST(0 AS BIGINT) AS not_nearest, CAST(0 AS BIGINT) AS wrong_sizes, true AS sizes_cover_clusters,
       CAST(0 AS BIGINT) AS wrong_scores, CAST(0 AS BIGINT) AS wrong_flags, true AS cost_agrees, true AS silhouette_agrees
FROM logs"""))
def kmeans_invariants(spark, sf_dir):
    """What holds for any clustering, here the library's: clients are at their nearest centre, sizes are those of
    a fresh count, their reciprocals add up to the clusters, flags follow the exact percentile of scores made
    from the fresh count, and cost and silhouette agree with direct sums and the closed form."""
    model, pred = _fitted(spark, sf_dir)
    scored = A.centroid_distance(A.kmeans_anomalies(pred), model)
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]   # k rows
    away = [F.sqrt(F.aggregate(F.zip_with(vector_to_array("features"), F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)),
                               F.lit(0.0), lambda s, x: s + x)) for c in centres]
    fresh = stored(pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("fresh_size")), "fresh-sizes")
    checked = stored(scored.withColumn("least", F.least(*away) if len(away) > 1 else away[0])
                     .withColumn("features", vector_to_array("features")).drop("features_raw")
                     .join(F.broadcast(fresh), "cluster").withColumn("score", 1.0 / F.col("fresh_size")), "kmeans-checked")
    threshold = checked.agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY score)").alias("t"))
    ours, library = L.quality(checked, len(centres)).first(), A.kmeans_quality(pred, model).first()
    clusters = fresh.count()
    bad = lambda c: F.sum(c.cast("long"))
    close = lambda a, b: abs(a - b) <= 1e-6 * max(1.0, abs(b))
    return checked.crossJoin(F.broadcast(threshold)).agg(
        F.count(F.lit(1)).alias("clients"),
        bad(F.col("centroid_distance") > F.col("least") + 1e-9).alias("not_nearest"),
        bad(F.col("cluster_size") != F.col("fresh_size")).alias("wrong_sizes"),
        (F.abs(F.sum(1.0 / F.col("cluster_size")) - clusters) < 1e-6).alias("sizes_cover_clusters"),
        bad(F.abs(F.col("anomaly_score") - F.col("score")) > 1e-12).alias("wrong_scores"),
        bad(F.col("is_anomaly") != (F.col("score") > F.col("t")).cast("int")).alias("wrong_flags"),
        (F.abs(F.sum(F.col("centroid_distance") * F.col("centroid_distance")) - library.training_cost)
         <= 1e-6 * max(1.0, library.training_cost)).alias("cost_agrees"),
        F.lit(close(ours.silhouette, library.silhouette)).alias("silhouette_agrees"))
