"""The bipartite client-to-URL graph (G1-G11) as two DataFrames.

No graph library: vertices ``(id, type)`` and edges
``(src, dst, weight, total_bytes, error_count)`` are plain DataFrames, and the
iterative algorithms are joins + aggregations.  A vertex is keyed by
``type:id`` inside the algorithms, so a string that is both a client and a
URL stays two vertices.

Scale notes:

* Degrees and per-vertex sums are one ``groupBy`` on the edge table, which is
  itself a partial aggregation of the logs by (ip, url).
* The iterative jobs first number the vertices in key order (one sort) and
  rewrite the adjacency over those 64-bit ids, so every round shuffles pairs
  of longs, not URL strings; keys come back with one join at the end.
* Each label-propagation step is: neighbour labels by a join of the
  undirected adjacency with the label table, a ``groupBy(vertex, label)``
  count, and a ``min(struct(-count, label))`` per vertex.  Both aggregations
  combine partially before the shuffle, so a hub URL (a logo every client
  fetches) never lands whole in one task; AQE splits the skewed join side.
* Connected components: alternating large-star and small-star steps until
  every component is a star.  Tables are stored as Parquet between steps, so
  both sides of each join are scans and AQE can split a hub.  Turning label ids
  back into keys splits only labels that are counted to be large.
* The top-k tables (community samples, neighbours) use ``row_number() <= k``,
  which Spark plans with a partial per-partition group limit before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsmith.functions.logline import looks_like_ip
from logsmith.operators.common import total_bytes
from logsmith.operators.components import connected_components as components
from logsmith.scratch import stored


@dataclass(frozen=True)
class AccessGraph:
    vertices: DataFrame
    edges: DataFrame


def graph_vertices(logs: DataFrame) -> DataFrame:
    """G1: distinct ips typed ``ip`` UNION ALL distinct urls typed ``url``."""
    ips = logs.select(F.col("ip").alias("id")).distinct().withColumn("type", F.lit("ip"))
    urls = logs.select(F.col("url").alias("id")).distinct().withColumn("type", F.lit("url"))
    return ips.unionByName(urls)


def vertices_from_edges(edges: DataFrame) -> DataFrame:
    """G1 from the edge table: distinct sources and destinations (no scan of the logs)."""
    ips = edges.select(F.col("src").alias("id")).distinct().withColumn("type", F.lit("ip"))
    urls = edges.select(F.col("dst").alias("id")).distinct().withColumn("type", F.lit("url"))
    return ips.unionByName(urls)


def graph_edges(logs: DataFrame) -> DataFrame:
    """One edge per (ip, url) with request count, bytes and errors."""
    return (logs.groupBy("ip", "url")
            .agg(F.count(F.lit(1)).alias("weight"),
                 total_bytes("bytes").alias("total_bytes"),
                 F.sum("is_error").alias("error_count"))
            .select(F.col("ip").alias("src"), F.col("url").alias("dst"),
                    "weight", "total_bytes", "error_count"))


def build_graph(logs: DataFrame) -> AccessGraph:
    """One edge table, and the vertices as its distinct ends (one scan of the logs)."""
    edges = graph_edges(logs)
    return AccessGraph(vertices_from_edges(edges), edges)


def graph_stats(g: AccessGraph) -> DataFrame:
    """Vertex, ip, url and edge counts as one row (three one-row aggregates)."""
    v = g.vertices.agg(F.count(F.lit(1)).alias("vertex_count"),
                       F.sum(F.when(F.col("type") == "ip", 1).otherwise(0)).cast("bigint").alias("ip_count"),
                       F.sum(F.when(F.col("type") == "url", 1).otherwise(0)).cast("bigint").alias("url_count"))
    e = g.edges.agg(F.count(F.lit(1)).alias("edge_count"))
    return v.crossJoin(e)


def ip_connectivity(edges: DataFrame) -> DataFrame:
    """Out-degree and totals of dotted-quad clients (host names left out).

    The reference joins an out-degree table to a per-source sum table; both are
    the same ``groupBy('src')``, fused here into one aggregation.
    """
    return (edges.filter(looks_like_ip(F.col("src")))
            .groupBy("src")
            .agg(F.count(F.lit(1)).alias("urls_visited"),
                 F.sum("weight").alias("total_requests"),
                 total_bytes("total_bytes").alias("total_bytes"),
                 F.sum("error_count").alias("total_errors"))
            .withColumnRenamed("src", "ip"))


def url_popularity(edges: DataFrame) -> DataFrame:
    """In-degree and totals of URL vertices whose id is not dotted-quad."""
    return (edges.filter(~looks_like_ip(F.col("dst")))
            .groupBy("dst")
            .agg(F.count(F.lit(1)).alias("unique_visitors"),
                 F.sum("weight").alias("total_hits"),
                 total_bytes("total_bytes").alias("total_bytes"))
            .withColumnRenamed("dst", "url"))


def high_error_edges(edges: DataFrame, min_error_rate: float = 0.5) -> DataFrame:
    """Edges with errors whose error fraction is above ``min_error_rate``."""
    return (edges.filter(F.col("error_count") > 0)
            .withColumn("error_rate", F.col("error_count") / F.col("weight"))
            .filter(F.col("error_rate") > min_error_rate))


def _error_heavy(edges: DataFrame, key: str, min_errors: int, min_rate: float) -> DataFrame:
    return (edges.groupBy(key)
            .agg(F.sum("error_count").alias("total_errors"), F.sum("weight").alias("total_requests"))
            .withColumn("error_rate", F.col("total_errors") / F.col("total_requests"))
            .filter((F.col("total_errors") > min_errors) & (F.col("error_rate") > min_rate)))


def error_ips(edges: DataFrame, min_errors: int = 10, min_rate: float = 0.3) -> DataFrame:
    """Sources with more than ``min_errors`` errors and an error fraction above ``min_rate``."""
    return _error_heavy(edges, "src", min_errors, min_rate)


def error_urls(edges: DataFrame, min_errors: int = 10, min_rate: float = 0.3) -> DataFrame:
    """The same test on destinations."""
    return _error_heavy(edges, "dst", min_errors, min_rate)


def ip_neighbors(edges: DataFrame, ip_address: str, limit: int = 20) -> DataFrame:
    """The urls a client visited most (ties by url)."""
    return (edges.filter(F.col("src") == ip_address)
            .select(F.col("dst").alias("url"), F.col("weight").alias("visit_count"),
                    "total_bytes", "error_count")
            .orderBy(F.desc("visit_count"), F.asc("url"))
            .limit(limit))


# ----------------------------------------------------------------------------- iterative

def vertex_key(type_col: Column, id_col: Column) -> Column:
    return F.concat(type_col, F.lit(":"), id_col)


def _keyed_vertices(vertices: DataFrame) -> DataFrame:
    return vertices.select("id", "type", vertex_key(F.col("type"), F.col("id")).alias("key"))


def _indexed(g: AccessGraph) -> tuple[DataFrame, DataFrame]:
    """Vertices numbered in key order, and the undirected adjacency over the numbers.

    A global sort by key followed by ``monotonically_increasing_id`` gives ids
    that increase with the key, so "smallest label" and "smallest member" mean
    the same with ids as with keys.  Rounds then shuffle pairs of longs instead
    of URL strings.  Both tables are stored once (the ids must not be
    recomputed, and every round reads them).
    """
    kv = stored(_keyed_vertices(g.vertices).orderBy("key")
                .withColumn("vid", F.monotonically_increasing_id()), "graph-vertices")
    ids = kv.select("key", "vid")
    e = (g.edges.select(vertex_key(F.lit("ip"), F.col("src")).alias("a"),
                        vertex_key(F.lit("url"), F.col("dst")).alias("b"))
         .join(ids.select(F.col("key").alias("a"), F.col("vid").alias("va")), on="a")
         .join(ids.select(F.col("key").alias("b"), F.col("vid").alias("vb")), on="b"))
    e = stored(e.select("va", "vb"), "graph-edges")
    adj = (e.select(F.col("va").alias("v"), F.col("vb").alias("n"))
           .unionByName(e.select(F.col("vb").alias("v"), F.col("va").alias("n"))))
    return kv, adj


#: Rows of one label that a single join key may hold; a label with more is split.
LABEL_ROWS = 100_000


def _join_on_label(rows: DataFrame, label_col: str, per_label: DataFrame, salt_by: str,
                   label_rows: int = LABEL_ROWS) -> DataFrame:
    """Join ``rows`` to ``per_label`` (one row per label value) on ``label_col``.

    Most vertices of a giant community or component share one label, so a plain join would
    send them all to one task.  Labels are counted first: one with more than ``label_rows``
    rows is split into that many parts by a salt from its rows' unique ``salt_by`` id, and
    only such a label's row is repeated, once per part.
    """
    parts = rows.groupBy(label_col).agg(F.ceil(F.count(F.lit(1)) / label_rows).cast("int").alias("_parts"))
    table = stored(per_label.join(parts, label_col).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))), "label-keys")
    split = table.where("_parts > 1 AND _salt = 0").select(label_col, "_parts")
    salted = rows.join(split, label_col, "left").withColumn(
        "_salt", F.pmod(F.col(salt_by), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    return salted.join(table.drop("_parts"), on=[label_col, "_salt"]).drop("_salt")


def _with_keys(kv: DataFrame, labels: DataFrame, out_col: str) -> DataFrame:
    """``(id, type, <out_col>)`` with the label id turned back into its vertex key."""
    labelled = kv.select("id", "type", "vid").join(
        labels.select(F.col("v").alias("vid"), F.col("l").alias("lid")), on="vid")
    label_keys = (labels.select(F.col("l").alias("lid")).distinct()
                  .join(kv.select(F.col("vid").alias("lid"), F.col("key").alias(out_col)), on="lid"))
    return _join_on_label(labelled, "lid", label_keys, salt_by="vid").select("id", "type", out_col)


def label_propagation(g: AccessGraph, max_iter: int = 5) -> DataFrame:
    """Synchronous label propagation, ``max_iter`` steps.

    Every vertex starts with its own key as label; at each step it takes the
    label most frequent among its neighbours (each edge counted once, both
    directions), the smallest label on ties; a vertex without neighbours keeps
    its label.  Returns ``(id, type, label)``.

    The label table is stored every round: both inputs of the next round's join
    are then plain scans, so AQE can split the partition of a hub vertex on the
    adjacency side.
    """
    kv, adj = _indexed(g)
    labels = kv.select(F.col("vid").alias("v"), F.col("vid").alias("l"))
    for step in range(1, max_iter + 1):
        nbr = labels.select(F.col("v").alias("n"), F.col("l").alias("nl"))
        votes = adj.join(nbr, on="n").groupBy("v", "nl").agg(F.count(F.lit(1)).alias("cnt"))
        best = (votes.groupBy("v")
                .agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("nl").alias("l"))).alias("b"))
                .select("v", F.col("b.l").alias("new_l")))
        labels = (labels.join(best, on="v", how="left")
                  .select("v", F.coalesce("new_l", "l").alias("l")))
        if step < max_iter:   # the last round's labels are read once, right below
            labels = stored(labels, "labels")
    return _with_keys(kv, labels, "label")


def community_sizes(communities: DataFrame) -> DataFrame:
    """Size and type mix per label."""
    return communities.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(F.when(F.col("type") == "ip", 1).otherwise(0)).cast("bigint").alias("ip_count"),
        F.sum(F.when(F.col("type") == "url", 1).otherwise(0)).cast("bigint").alias("url_count"))


def community_samples(communities: DataFrame, top_communities: int = 5, per_community: int = 10) -> DataFrame:
    """The ``per_community`` first members (by type, id) of the largest communities.

    One job for all communities (the reference runs one filter job per community).
    The top-community set has at most ``top_communities`` rows, so it is broadcast.
    """
    sizes = community_sizes(communities)
    top = (sizes.orderBy(F.desc("size"), F.asc("label")).limit(top_communities)
           .select("label", "size"))
    w = Window.partitionBy("label").orderBy("type", "id")
    return (communities.join(F.broadcast(top), on="label")
            .withColumn("member_rank", F.row_number().over(w))
            .filter(F.col("member_rank") <= per_community)
            .select("label", "size", "member_rank", "id", "type"))


def connected_components(g: AccessGraph) -> DataFrame:
    """Undirected components; the component id is the smallest member key.

    Large-star / small-star steps over the vertex numbers (``operators.components``) until
    every component is a star; no cap on rounds.  A vertex without edges is its own component.
    """
    kv, adj = _indexed(g)
    parts = components(adj, "v", "n")
    labels = stored(kv.select("vid").join(parts, kv["vid"] == parts["node"], "left")
                    .select(F.col("vid").alias("v"), F.coalesce("component", "vid").alias("l")), "component-labels")
    return _with_keys(kv, labels, "component")


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
