"""Graph operators on hand-made graphs, checked against plain-Python brute force."""

from collections import Counter, defaultdict

from logsmith.operators import graph as G

# Small bipartite graphs (client -> url):
TWO_BLOCKS = [("a1", "/u1"), ("a1", "/u2"), ("a2", "/u1"), ("a2", "/u2"),
              ("b1", "/v1"), ("b1", "/v2"), ("b2", "/v1"), ("b2", "/v2"), ("a1", "/v1")]
PATH = [(f"p{i}", f"/q{i}") for i in range(5)] + [(f"p{i + 1}", f"/q{i}") for i in range(4)]
STAR = [("s", f"/s{i}") for i in range(20)]
PAIR = [("x", "/x")]
COLLIDE = [("1.2.3.4", "/c"), ("9.9.9.9", "1.2.3.4")]
ALL = TWO_BLOCKS + PATH + STAR + PAIR + COLLIDE


def logs_of(spark, pairs, errors=()):
    rows = [(ip, url, 10, 1 if (ip, url) in errors else 0) for ip, url in pairs]
    return spark.createDataFrame(rows, "ip string, url string, bytes long, is_error int")


def keyed(pairs):
    verts = {f"ip:{a}" for a, _ in pairs} | {f"url:{b}" for _, b in pairs}
    adj = defaultdict(set)
    for a, b in set(pairs):
        adj[f"ip:{a}"].add(f"url:{b}")
        adj[f"url:{b}"].add(f"ip:{a}")
    return verts, adj


def lpa_brute(pairs, steps):
    verts, adj = keyed(pairs)
    labels = {v: v for v in verts}
    for _ in range(steps):
        new = {}
        for v in verts:
            if adj[v]:
                c = Counter(labels[n] for n in adj[v])
                new[v] = min(c, key=lambda lab: (-c[lab], lab))
            else:
                new[v] = labels[v]
        labels = new
    return labels


def cc_brute(pairs):
    verts, adj = keyed(pairs)
    comp = {}
    for v in sorted(verts):
        if v in comp:
            continue
        stack, seen = [v], {v}
        while stack:
            x = stack.pop()
            for n in adj[x]:
                if n not in seen:
                    seen.add(n)
                    stack.append(n)
        root = min(seen)
        for x in seen:
            comp[x] = root
    return comp


def test_vertices_keep_collisions_apart(spark):
    g = G.build_graph(logs_of(spark, COLLIDE))
    ids = sorted((r.id, r.type) for r in g.vertices.collect())
    assert ("1.2.3.4", "ip") in ids and ("1.2.3.4", "url") in ids
    stats = G.graph_stats(g).collect()[0]
    assert (stats.vertex_count, stats.ip_count, stats.url_count, stats.edge_count) == (4, 2, 2, 2)


def test_label_propagation_matches_brute_force(spark):
    for steps in (1, 2, 5):
        g = G.build_graph(logs_of(spark, ALL))
        got = {f"{r.type}:{r.id}": r.label for r in G.label_propagation(g, max_iter=steps).collect()}
        assert got == lpa_brute(ALL, steps), steps


def test_connected_components_match_brute_force(spark):
    g = G.build_graph(logs_of(spark, ALL))
    got = {f"{r.type}:{r.id}": r.component for r in G.connected_components(g).collect()}
    assert got == cc_brute(ALL)
    sizes = sorted(r.size for r in G.component_sizes(G.connected_components(g)).collect())
    assert sizes == sorted(Counter(cc_brute(ALL).values()).values())


def test_degrees_and_patterns(spark):
    errs = {("a1", "/u1"), ("a1", "/u2"), ("a1", "/v1")}
    logs = logs_of(spark, TWO_BLOCKS + COLLIDE + TWO_BLOCKS, errors=errs)
    g = G.build_graph(logs)
    conn = {r.ip: r for r in G.ip_connectivity(g.edges).collect()}
    # dotted-quad sources only; host names are left out as in the reference
    assert set(conn) == {"1.2.3.4", "9.9.9.9"}
    pop = {r.url: r for r in G.url_popularity(g.edges).collect()}
    assert "1.2.3.4" not in pop and pop["/u1"].unique_visitors == 2 and pop["/u1"].total_hits == 4
    high = {(r.src, r.dst) for r in G.high_error_edges(g.edges).collect()}
    assert high == errs
    nb = G.ip_neighbors(g.edges, "a1", limit=2).collect()
    assert [r.url for r in nb] == ["/u1", "/u2"]


def test_community_samples_top_k(spark):
    g = G.build_graph(logs_of(spark, ALL))
    comm = G.label_propagation(g, max_iter=5)
    samples = G.community_samples(comm, top_communities=2, per_community=3).collect()
    assert len({r.label for r in samples}) == 2
    assert all(1 <= r.member_rank <= 3 for r in samples)


def test_component_constant_across_edges(spark):
    from pyspark.sql import functions as F
    from logsmith.operators.parsing import parse_logs
    from logsmith.sources.fixtures import event_log_lines
    logs = parse_logs(event_log_lines(spark, "/root/testdata/sf0.001"))
    g = G.build_graph(logs)
    comp = G.connected_components(g)
    ip_c = comp.filter("type = 'ip'").select(F.col("id").alias("src"), F.col("component").alias("cs"))
    url_c = comp.filter("type = 'url'").select(F.col("id").alias("dst"), F.col("component").alias("cd"))
    joined = g.edges.join(ip_c, "src").join(url_c, "dst")
    assert joined.count() == g.edges.count()
    assert joined.filter(F.col("cs") != F.col("cd")).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    from logsmith.operators.components import connected_components
    chain = [(i, i + 1) for i in range(2000)]
    hub = [(5000, 5001 + i) for i in range(500)]
    df = spark.createDataFrame(chain[::-1] + hub + [(7, 7), (9000, 9000)], "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(2001)} | {5000 + i: 5000 for i in range(501)}
    assert connected_components(df.limit(0)).collect() == []
