"""KPI invariants, reference defects handled, anomaly scoring properties."""

from pyspark.sql import functions as F

from helpers import lines_df
from logsmith.operators import anomaly as A
from logsmith.operators import graph as G
from logsmith.operators import kpis, metrics, panels
from logsmith.operators.parsing import parse_logs
from logsmith.sources.fixtures import event_log_lines

SF = "/root/testdata/sf0.01"


def _logs(spark):
    return parse_logs(event_log_lines(spark, SF)).cache()


def test_sums_agree(spark):
    logs = _logs(spark)
    n = logs.count()
    assert kpis.access_per_minute(logs).agg(F.sum("access_count")).first()[0] == n
    assert kpis.http_status(logs).agg(F.sum("count")).first()[0] == n
    assert G.graph_edges(logs).agg(F.sum("weight")).first()[0] == n
    counts = {r.kpi: r.row_count for r in kpis.kpi_row_counts(kpis.all_kpis(logs)).collect()}
    assert counts["top_urls"] == 20 and counts["peaks"] > 0


def test_null_timestamps_group_in_hourly_but_not_in_windows(spark):
    lines = ['h - - [01/Jul/1995:00:00:01 +0000] "GET /a HTTP/1.0" 200 1',
             'h - - [32/Jul/1995:00:00:01 +0000] "GET /a HTTP/1.0" 200 1']
    logs = parse_logs(lines_df(spark, lines))
    assert kpis.access_per_hour(logs).count() == 2
    assert kpis.traffic_volume(logs).count() == 1


def test_peaks_empty_input(spark):
    empty = parse_logs(spark.createDataFrame([], "value string"))
    assert kpis.peaks(empty).count() == 0


def test_top_k_tie_break(spark):
    lines = [f'h{i} - - [01/Jul/1995:00:00:01 +0000] "GET /{c} HTTP/1.0" 200 1' for i, c in enumerate("dcba")]
    top = kpis.top_urls(parse_logs(lines_df(spark, lines)), top_n=2).collect()
    assert [r.url for r in top] == ["/a", "/b"]


def test_zscore_zero_deviation(spark):
    feats = spark.createDataFrame(
        [(f"ip{i}", 5, 1.0, 0.5, 2, 3, 10) for i in range(4)],
        "ip string, request_count long, error_rate double, bytes_per_request double, "
        "unique_urls long, error_count long, total_bytes long")
    rows = A.zscore_anomalies(feats).collect()
    assert all(r.z_score_requests is None and r.max_z_score is None and r.is_anomaly == 0 for r in rows)


def test_kmeans_any_k_and_scores(spark):
    feats = A.client_features(_logs(spark))
    n = feats.count()
    model = A.fit_kmeans(A.kmeans_input(feats), k=7)
    pred = model.transform(A.kmeans_input(feats))
    sizes = A.cluster_sizes(pred).collect()
    assert sum(r.cluster_size for r in sizes) == n and len(sizes) <= 7
    scored = A.kmeans_anomalies(pred)
    bad = scored.filter((F.col("anomaly_score") <= 0) | (F.col("anomaly_score") > 1)).count()
    assert bad == 0 and scored.count() == n
    dist = A.centroid_distance(pred, model)
    assert dist.filter(F.col("centroid_distance") < 0).count() == 0
    q = A.kmeans_quality(pred, model).first()
    assert q.k == 7 and q.training_cost >= 0


def test_semi_join_equals_ip_list(spark):
    logs = _logs(spark)
    z = A.zscore_anomalies(A.client_features(logs))
    flagged = [r.ip for r in z.filter("is_anomaly = 1").select("ip").collect()]
    semi = A.anomalous_requests(logs, z)
    assert semi.count() == logs.filter(F.col("ip").isin(flagged)).count() > 0


def test_histogram_is_cumulative_over_all_rows(spark):
    logs = _logs(spark)
    h = {(r.name, r.le): r.value for r in metrics.response_size_histogram(logs).collect()}
    bounds = [h[("log_response_size_bytes_bucket", le)] for _, le in metrics.SIZE_BUCKETS]
    assert bounds == sorted(bounds)
    observed = logs.filter("bytes IS NOT NULL AND bytes <> 0").count()
    assert bounds[-1] == h[("log_response_size_bytes_count", "")] == observed


def test_sustained_alert(spark):
    # 6 consecutive minutes all errors, then one clean minute: fires from the 5th to the 6th
    lines = [f'h - - [01/Jul/1995:00:0{m}:01 +0000] "GET /a HTTP/1.0" 500 1' for m in range(6)]
    lines += ['h - - [01/Jul/1995:00:07:01 +0000] "GET /a HTTP/1.0" 200 1']
    out = {r.minute: r.firing for r in panels.alert_error_rate(parse_logs(lines_df(spark, lines))).collect()}
    assert [out[f"1995-07-01 00:0{m}"] for m in (0, 1, 2, 3, 4, 5, 7)] == [0, 0, 0, 0, 1, 1, 0]


def test_rollup_paths_equal_direct_paths(spark):
    logs = _logs(spark)
    r = kpis.minute_rollup(logs)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(kpis.http_status(logs), kpis.http_status(logs, r))
    assert same(kpis.peaks(logs), kpis.peaks(logs, rollup=r))
    assert same(panels.alert_error_rate(logs), panels.alert_error_rate(logs, rollup=r))
    z = A.zscore_anomalies(A.client_features(logs))
    assert same(metrics.metrics_snapshot(logs, z), metrics.metrics_snapshot(logs, z, r))


def test_edge_paths_equal_direct_paths(spark):
    logs = _logs(spark)
    e = G.graph_edges(logs)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(kpis.top_urls(logs, top_n=50), kpis.top_urls(logs, top_n=50, edges=e))
    assert same(kpis.top_ips(logs, top_n=50), kpis.top_ips(logs, top_n=50, edges=e))
    assert same(G.graph_vertices(logs), G.vertices_from_edges(e))


def test_client_rollup_paths_equal_direct_paths(spark):
    from logsmith.operators.common import round_doubles
    logs = _logs(spark)
    c = kpis.minute_client_rollup(logs)

    def same(a, b):
        a, b = round_doubles(a), round_doubles(b)
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(kpis.access_per_hour(logs), kpis.access_per_hour(logs, c))
    assert same(kpis.access_per_minute(logs), kpis.access_per_minute(logs, c))
    assert same(kpis.traffic_volume(logs), kpis.traffic_volume(logs, clients=c))
