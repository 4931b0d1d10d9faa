"""Registered queries: the client-to-URL graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.plans.anomaly_queries import EDGES_CTE
from logsmith.plans.oracle import with_logs
from logsmith.plans.registry import logs_table, register

DOTTED = r"^\d+\.\d+\.\d+\.\d+"
NEIGHBOR_IP = "10.0.0.1"   # the heaviest client of the fixture
LPA_STEPS = 5

VERTICES_CTE = """vertices AS (
  SELECT DISTINCT ip AS id, 'ip' AS type FROM logs
  UNION ALL
  SELECT DISTINCT url AS id, 'url' AS type FROM logs)"""

GRAPH_CTES = EDGES_CTE + ",\n" + VERTICES_CTE + """,
adj AS (SELECT 'ip:' || src AS v, 'url:' || dst AS n FROM edges
        UNION ALL SELECT 'url:' || dst AS v, 'ip:' || src AS n FROM edges),
kv AS (SELECT id, type, type || ':' || id AS v FROM vertices)"""


def _lpa_ctes(steps: int) -> str:
    parts = ["l0 AS (SELECT v, v AS label FROM kv)"]
    for i in range(1, steps + 1):
        prev = f"l{i - 1}"
        parts.append(f"""l{i} AS (
  SELECT p.v, coalesce(b.nlabel, p.label) AS label
  FROM {prev} p LEFT JOIN (
    SELECT v, nlabel FROM (
      SELECT v, nlabel, row_number() OVER (PARTITION BY v ORDER BY cnt DESC, nlabel ASC) AS rn
      FROM (SELECT a.v, q.label AS nlabel, count(*) AS cnt
            FROM adj a JOIN {prev} q ON a.n = q.v GROUP BY a.v, q.label))
    WHERE rn = 1) b ON p.v = b.v)""")
    parts.append(f"communities AS (SELECT kv.id, kv.type, l.label FROM kv JOIN l{steps} l ON kv.v = l.v)")
    return ",\n".join(parts)


LPA_CTES = GRAPH_CTES + ",\n" + _lpa_ctes(LPA_STEPS)
COMMUNITY_SIZES_CTE = """csize AS (
  SELECT label, count(*) AS size, CAST(sum(CASE WHEN type = 'ip' THEN 1 ELSE 0 END) AS BIGINT) AS ip_count,
         CAST(sum(CASE WHEN type = 'url' THEN 1 ELSE 0 END) AS BIGINT) AS url_count
  FROM communities GROUP BY label)"""

CC_CTES = GRAPH_CTES + """,
reach(v, r) AS (SELECT v, v FROM kv UNION SELECT a.n, reach.r FROM reach JOIN adj a ON a.v = reach.v),
components AS (SELECT kv.id, kv.type, min(reach.r) AS component FROM kv JOIN reach ON kv.v = reach.v
               GROUP BY kv.id, kv.type)"""


def graph_of(spark, sf_dir) -> G.AccessGraph:
    return G.build_graph(logs_table(spark, sf_dir))


@register("graph_vertices", "G1", with_logs("SELECT id, type FROM vertices", VERTICES_CTE))
def graph_vertices(spark, sf_dir):
    return graph_of(spark, sf_dir).vertices


@register("graph_edges", "G2", with_logs("SELECT * FROM edges", EDGES_CTE))
def graph_edges(spark, sf_dir):
    return graph_of(spark, sf_dir).edges


@register("graph_stats", "G3", with_logs("""
SELECT (SELECT count(*) FROM vertices) AS vertex_count,
       (SELECT count(*) FROM vertices WHERE type = 'ip') AS ip_count,
       (SELECT count(*) FROM vertices WHERE type = 'url') AS url_count,
       (SELECT count(*) FROM edges) AS edge_count""", EDGES_CTE + ",\n" + VERTICES_CTE))
def graph_stats(spark, sf_dir):
    return G.graph_stats(graph_of(spark, sf_dir))


@register("ip_connectivity", "G4", with_logs(f"""
SELECT src AS ip, count(*) AS urls_visited, CAST(sum(weight) AS BIGINT) AS total_requests,
       CAST(sum(total_bytes) AS BIGINT) AS total_bytes, CAST(sum(error_count) AS BIGINT) AS total_errors
FROM edges WHERE regexp_matches(src, '{DOTTED}') GROUP BY src""", EDGES_CTE))
def ip_connectivity(spark, sf_dir):
    return G.ip_connectivity(graph_of(spark, sf_dir).edges)


@register("url_popularity", "G5", with_logs(f"""
SELECT dst AS url, count(*) AS unique_visitors, CAST(sum(weight) AS BIGINT) AS total_hits,
       CAST(sum(total_bytes) AS BIGINT) AS total_bytes
FROM edges WHERE NOT regexp_matches(dst, '{DOTTED}') GROUP BY dst""", EDGES_CTE))
def url_popularity(spark, sf_dir):
    return G.url_popularity(graph_of(spark, sf_dir).edges)


@register("communities", "G6", with_logs("SELECT id, type, label FROM communities", LPA_CTES))
def communities(spark, sf_dir):
    return G.label_propagation(graph_of(spark, sf_dir), max_iter=LPA_STEPS)


@register("community_sizes", "G7", with_logs("SELECT * FROM csize", LPA_CTES + ",\n" + COMMUNITY_SIZES_CTE))
def community_sizes(spark, sf_dir):
    return G.community_sizes(G.label_propagation(graph_of(spark, sf_dir), max_iter=LPA_STEPS))


@register("community_samples", "G8", with_logs("""
SELECT label, size, member_rank, id, type FROM (
  SELECT c.label, t.size,
         CAST(row_number() OVER (PARTITION BY c.label ORDER BY c.type, c.id) AS INTEGER) AS member_rank,
         c.id, c.type
  FROM communities c JOIN (SELECT label, size FROM csize ORDER BY size DESC, label ASC LIMIT 5) t
       ON c.label = t.label)
WHERE member_rank <= 10""", LPA_CTES + ",\n" + COMMUNITY_SIZES_CTE))
def community_samples(spark, sf_dir):
    return G.community_samples(G.label_propagation(graph_of(spark, sf_dir), max_iter=LPA_STEPS))


@register("connected_components", "G9", with_logs("SELECT id, type, component FROM components", CC_CTES))
def connected_components(spark, sf_dir):
    return G.connected_components(graph_of(spark, sf_dir))


@register("component_sizes", "G9", with_logs(
    "SELECT component, count(*) AS size FROM components GROUP BY component", CC_CTES))
def component_sizes(spark, sf_dir):
    return G.component_sizes(G.connected_components(graph_of(spark, sf_dir)))


@register("high_error_edges", "G10a", with_logs("""
SELECT src, dst, weight, total_bytes, error_count, round(CAST(error_count AS DOUBLE) / weight, 6) AS error_rate
FROM edges WHERE error_count > 0 AND CAST(error_count AS DOUBLE) / weight > 0.5""", EDGES_CTE))
def high_error_edges(spark, sf_dir):
    return G.high_error_edges(graph_of(spark, sf_dir).edges)


def _error_heavy_sql(key: str) -> str:
    return with_logs(f"""
SELECT {key}, total_errors, total_requests, round(CAST(total_errors AS DOUBLE) / total_requests, 6) AS error_rate
FROM (SELECT {key}, CAST(sum(error_count) AS BIGINT) AS total_errors, CAST(sum(weight) AS BIGINT) AS total_requests
      FROM edges GROUP BY {key})
WHERE total_errors > 10 AND CAST(total_errors AS DOUBLE) / total_requests > 0.3""", EDGES_CTE)


@register("error_ips", "G10b", _error_heavy_sql("src"))
def error_ips(spark, sf_dir):
    return G.error_ips(graph_of(spark, sf_dir).edges)


@register("error_urls", "G10c", _error_heavy_sql("dst"))
def error_urls(spark, sf_dir):
    return G.error_urls(graph_of(spark, sf_dir).edges)


@register("ip_neighbors", "G11", with_logs(f"""
SELECT dst AS url, weight AS visit_count, total_bytes, error_count FROM edges
WHERE src = '{NEIGHBOR_IP}' ORDER BY visit_count DESC, url ASC LIMIT 20""", EDGES_CTE))
def ip_neighbors(spark, sf_dir):
    return G.ip_neighbors(graph_of(spark, sf_dir).edges, NEIGHBOR_IP)


# Many components: clients and urls of the whole table are split into 40 sites by client, and
# half the urls of a site are its own, so that the sites do not touch.
SITES = 40
SITE_CTES = f"""slogs AS (
  SELECT 's' || CAST(site AS VARCHAR) || '-' || ip AS ip, '/s' || CAST(site AS VARCHAR) || url AS url, bytes, is_error
  FROM (SELECT *, (length(ip) * 7 + CAST(ascii(substr(ip, length(ip), 1)) AS BIGINT) * 3
                   + CAST(ascii(substr(ip, length(ip) - 1, 1)) AS BIGINT) * 11) % {SITES} AS site FROM logs)),
edges AS (
  SELECT ip AS src, url AS dst, count(*) AS weight, CAST(sum(bytes) AS BIGINT) AS total_bytes,
         CAST(sum(is_error) AS BIGINT) AS error_count
  FROM slogs GROUP BY ip, url),
vertices AS (SELECT DISTINCT src AS id, 'ip' AS type FROM edges UNION ALL SELECT DISTINCT dst AS id, 'url' AS type FROM edges)"""
SITE_GRAPH_CTES = SITE_CTES + GRAPH_CTES[GRAPH_CTES.index(",\nadj AS"):]


def site_graph(spark, sf_dir) -> G.AccessGraph:
    logs = logs_table(spark, sf_dir)
    at = lambda back: F.ascii(F.substring("ip", -back, 1)).cast("long")
    site = ((F.length("ip") * 7 + at(1) * 3 + F.ascii(F.expr("substring(ip, length(ip) - 1, 1)")).cast("long") * 11)
            % SITES).cast("string")
    return G.build_graph(logs.withColumn("_site", site)
                         .withColumn("ip", F.concat(F.lit("s"), "_site", F.lit("-"), "ip"))
                         .withColumn("url", F.concat(F.lit("/s"), "_site", "url")))


@register("communities_multi", "G6", with_logs(
    "SELECT id, type, label FROM communities", SITE_GRAPH_CTES + ",\n" + _lpa_ctes(LPA_STEPS)))
def communities_multi(spark, sf_dir):
    return G.label_propagation(site_graph(spark, sf_dir), max_iter=LPA_STEPS)


@register("connected_components_multi", "G9", with_logs(
    "SELECT id, type, component FROM components",
    SITE_GRAPH_CTES + CC_CTES[CC_CTES.index(",\nreach(v, r)"):]))
def connected_components_multi(spark, sf_dir):
    return G.connected_components(site_graph(spark, sf_dir))


@register("isolated_clients", "M14", with_logs("""
SELECT c.id AS ip, c.component, t.component_size, 'isolated' AS label
FROM components c JOIN (SELECT component, count(*) AS component_size FROM components GROUP BY component) t
     ON c.component = t.component
WHERE c.type = 'ip' AND t.component_size <= 120""", SITE_GRAPH_CTES + CC_CTES[CC_CTES.index(",\nreach(v, r)"):]))
def isolated_clients(spark, sf_dir):
    return A.isolated_clients(G.connected_components(site_graph(spark, sf_dir)), max_size=120)
