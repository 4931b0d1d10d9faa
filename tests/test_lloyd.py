"""Deterministic K-Means against numpy, and its closed-form quality against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from logsmith.operators import lloyd as L


def clients(n=120, seed=3, dims=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        middle = rng.choice([0, 0, 0, 10, 25])
        rows.append((f"ip{i:04d}", *[round(rng.gauss(middle, 1 + d), 3) for d in range(dims - 1)], 7.0))
    return rows + [("ip9990", None, 1.0, 2.0, 7.0), ("ip9991", *rows[5][1:])]


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, "ip string, f0 double, f1 double, f2 double, f3 double").repartition(parts)


COLUMNS = ["f0", "f1", "f2", "f3"]


def plain_lloyd(rows, k, steps=20):
    """(ips, scaled, centres, cluster of each client)"""
    rows = sorted(rows)
    x = np.array([[v or 0.0 for v in r[1:]] for r in rows])
    dev = x.std(axis=0, ddof=1)
    x = np.where(dev > 0, np.round((x - x.mean(axis=0)) / np.where(dev > 0, dev, 1), L.PLACES), 0.0)
    seeds = [x[0]]
    while len(seeds) < k:
        d = np.min([((x - s) ** 2).sum(axis=1) for s in seeds], axis=0)
        if d.max() <= 0:
            break
        seeds.append(x[int(np.argmax(d))])
    c = np.array(seeds)
    for _ in range(steps):
        at = np.argmin([((x - s) ** 2).sum(axis=1) for s in c], axis=0)
        c = np.array([x[at == i].mean(axis=0) if (at == i).any() else c[i] for i in range(len(c))])
    at = np.argmin([((x - s) ** 2).sum(axis=1) for s in c], axis=0)
    return [r[0] for r in rows], x, c, at


def test_equals_plain_lloyd_on_any_partitioning(spark):
    rows = clients()
    ips, x, centres, at = plain_lloyd(rows, 4)
    for parts in (1, 7):
        scaled = L.scaled_features(table(spark, rows, parts), COLUMNS)
        fitted = L.fit(scaled, 4)
        assert fitted.at_rest and np.allclose(fitted.centres, centres)
        got = {r.ip: r for r in fitted.assign(scaled).collect()}
        assert [got[ip].cluster for ip in ips] == at.tolist()
        assert np.allclose([got[ip].centroid_distance for ip in ips], np.sqrt(((x - centres[at]) ** 2).sum(axis=1)))
        assert got["ip0000"].features[3] == 0.0                      # no deviation


def test_quality_equals_all_pairs(spark):
    rows = clients(80)
    ips, x, centres, at = plain_lloyd(rows, 5)
    scaled = L.scaled_features(table(spark, rows), COLUMNS)
    clustered = L.fit(scaled, 5).assign(scaled)
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(x)):
        mine = at == at[i]
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][mine].sum() / (mine.sum() - 1)
        b = min(d[i][at == c].mean() for c in set(at.tolist()) - {at[i]})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    q = L.quality(clustered, 5).first()
    assert abs(q.silhouette - np.mean(scores)) < 1e-9
    assert abs(q.training_cost - sum(d[i][at == at[i]].sum() / (2 * (at == at[i]).sum()) for i in range(len(x)))) < 1e-6


def test_few_and_no_clients(spark):
    one = L.scaled_features(table(spark, [("a", 1.0, 2.0, 3.0, 4.0)]), COLUMNS)
    fitted = L.fit(one, 5)
    assert fitted.centres == ((0.0, 0.0, 0.0, 0.0),) and fitted.assign(one).first().cluster == 0
    q = L.quality(fitted.assign(one), 5).first()
    assert q.silhouette is None and q.training_cost == 0 and q.k == 5
    same = L.scaled_features(table(spark, [(f"i{i}", 1.0, 2.0, 3.0, 4.0) for i in range(9)]), COLUMNS)
    assert len(L.fit(same, 3).centres) == 1
    none = L.scaled_features(table(spark, []), COLUMNS)
    assert L.fit(none, 3).centres == () and L.fit(none, 3).assign(none).count() == 0
    assert L.quality(L.fit(none, 3).assign(none), 3).first().silhouette is None


def test_a_step_is_one_pass_without_a_client_shuffle(spark):
    scaled = L.scaled_features(table(spark, clients()), COLUMNS).checkpoint(eager=True)
    fitted = L.fit(scaled, 3, max_steps=2)
    assert fitted.steps <= 2 and len(fitted.centres) == 3
    plan = fitted.assign(scaled).agg(F.count("cluster"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
