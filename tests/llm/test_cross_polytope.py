import numpy as np
import pytest

from logsmith.llm import cross_polytope as C

SCHEMA = "vec_id long, embedding array<float>, label int, point string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "clash", "clash")
                                  for i, v in rows], SCHEMA)


def exact(rows, query, step=20):
    v = dict(rows)[query].astype(float)
    scored = sorted((-float(sum(a * b for a, b in zip(v, w.astype(float)))), i) for i, w in rows if i != query)
    return [(i, -s) for s, i in scored[:C.TOP]]


def results(df):
    out = {}
    for r in C.nearest_neighbours(df).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_rotation_keeps_lengths_and_axes():
    x = np.random.default_rng(0).normal(size=(50, 20))
    signs = C.rotations(20, 2)
    assert signs.shape == (C.TABLES, 2, C.ROUNDS, 32) and (signs[:, :1] == C.rotations(20, 1)).all()
    assert np.allclose(np.linalg.norm(C.rotated(x, signs[0, 0]), axis=1), np.linalg.norm(x, axis=1))
    axes, short = C.nearest_axes(x, signs), C.shortfalls(x, signs)
    assert (np.take_along_axis(short, axes[..., None], 3) == 0).all() and (short >= 0).all()


def test_probed_codes_are_all_within_reach():
    short = np.random.default_rng(1).uniform(0, 1, size=(3, 6))
    want = {a * 36 + b * 6 + c for a in range(6) for b in range(6) for c in range(6)
            if short[0, a] + short[1, b] + short[2, c] <= 1.1}
    assert set(C.probed_codes(short, 3, 1.1).tolist()) == want and want
    assert C.depth(64, 500) == 1 and C.depth(64, 2000) == 2 and C.depth(64, 10**6) == 3


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float32)) for r in
            spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = results(frame(spark, rows))
    hits = 0
    for q, found in got.items():
        want = dict(exact(rows, q))
        assert [r for r, _, _ in found] == list(range(1, C.TOP + 1))
        assert all(abs(s - float(np.dot(dict(rows)[q].astype(float), dict(rows)[i].astype(float)))) < 1e-12 for _, i, s in found)
        hits += sum(i in want for _, i, _ in found)
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    assert hits >= 0.9 * C.TOP * len(got)


def test_lengths_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8).astype(np.float32)
    rows = [(i, hot if i % 3 == 0 else (rng.normal(size=8) * rng.uniform(0.1, 4)).astype(np.float32)) for i in range(300)]
    got = results(frame(spark, rows).repartition(5))
    hits = total = 0
    for q, found in got.items():
        want = exact(rows, q)
        assert len(found) == C.TOP and q not in [i for _, i, _ in found]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in want})
        total += C.TOP
    assert hits >= 0.9 * total


def test_bad_vectors_take_no_part(spark):
    good = [(i, np.array([1.0, i, 0, 0], dtype=np.float32)) for i in range(0, 60, 5)]
    bad = [(100, None), (120, []), (140, [0, 0, 0, 0]), (160, [1, None, 0, 0]), (180, [float("nan"), 1, 0, 0]),
           (200, [float("inf"), 1, 0, 0]), (None, [1, 1, 0, 0])]
    got = results(frame(spark, good + bad + [good[0], (220, [1.0, 2.0])]))
    assert set(got) == {0, 20, 40}
    assert {i for f in got.values() for _, i, _ in f} <= {i for i, _ in good}
    assert C.nearest_neighbours(frame(spark, [])).collect() == []


def recall(spark, vectors):
    rows = [(i, v.astype(np.float32)) for i, v in enumerate(vectors)]
    got = results(frame(spark, rows).repartition(4))
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    matrix = np.array([v.astype(float) for _, v in rows])
    hits = 0
    for q, found in got.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        n = min(C.TOP, len(rows) - 1)
        assert len(found) == n                       # all candidates, if fewer
        hits += len({i for _, i, _ in found} & set(np.argsort(-scores, kind="stable")[:n].tolist()))
    return hits / sum(len(f) for f in got.values())


@pytest.mark.parametrize("case", ["unit", "outlier", "lognormal", "hundred", "fifteen"])
def test_recall_for_any_lengths_and_sizes(spark, case):
    rng = np.random.default_rng(5)
    x = rng.normal(size=({"hundred": 100, "fifteen": 15}.get(case, 3000), 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if case == "outlier":
        x[77] *= 100
    if case == "lognormal":
        x *= np.exp(rng.normal(size=(len(x), 1)))
    assert recall(spark, x) >= (1.0 if case == "fifteen" else 0.9)


def test_extreme_lengths_and_repeated_ids(spark):
    small, large = [1e-300, 2e-300, 0.0], [1e150, -1e150, 1e150]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(0, small), (20, large), (1, [1.0, 1.0, 1.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0])], schema)
    got = results(df)
    assert sorted(i for _, i, _ in got[0]) == [1, 1, 2, 20]
    assert sorted(i for _, i, _ in got[20]) == [0, 1, 1, 2]
