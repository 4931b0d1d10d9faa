import itertools

import numpy as np
from edge import edge_docs, edge_rows, empty_docs

from logsmith.llm import language_crf as L
from logsmith.llm.queries import QUERIES
from logsmith.llm.stages import keep_known_languages


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(0)
    k, offsets = 3, np.array([0, 4, 4, 5, 9])
    scores, moves, start = rng.normal(size=(9, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    got = L.posteriors(scores, offsets, moves, start)
    for a, b in zip(offsets[:-1], offsets[1:]):
        sums = np.zeros((b - a, k))
        for path in itertools.product(range(k), repeat=int(b - a)):
            w = start[path[0]] if path else 0
            w += sum(scores[a + i, y] for i, y in enumerate(path)) + sum(moves[x, y] for x, y in zip(path, path[1:]))
            for i, y in enumerate(path):
                sums[i, y] += np.exp(w)
        if b > a:
            assert np.allclose(got[a:b], sums / sums.sum(axis=1, keepdims=True))


def test_blocks_do_not_matter():
    rng = np.random.default_rng(1)
    k, n = 4, 2000
    scores, moves, start = rng.normal(size=(n, k)) * 3, rng.normal(size=(k, k)), rng.normal(size=k)
    offsets = np.array([0, 3, 900, 900, n])
    got, alpha = L.posteriors(scores, offsets, moves, start), None
    for a, b in zip(offsets[:-1], offsets[1:]):
        f, g = np.zeros((b - a, k)), np.ones((b - a, k))
        for t in range(b - a):
            alpha = np.exp(start) if t == 0 else f[t - 1] @ np.exp(moves)
            f[t] = alpha * np.exp(scores[a + t])
            f[t] /= f[t].sum()
        for t in range(b - a - 2, -1, -1):
            g[t] = np.exp(moves) @ (np.exp(scores[a + t + 1]) * g[t + 1])
            g[t] /= g[t].sum()
        if b > a:
            assert np.allclose(got[a:b], f * g / (f * g).sum(axis=1, keepdims=True))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    k, lengths = 3, np.array([4, 2])
    s, gold, m, st = rng.normal(size=(2, 4, k)), rng.integers(0, k, (2, 4)), rng.normal(size=(k, k)), rng.normal(size=k)

    def loss(s, m, st):
        out = 0.0
        for i in range(2):
            total, own = [], None
            for path in itertools.product(range(k), repeat=int(lengths[i])):
                e = st[path[0]] + sum(s[i, j, y] for j, y in enumerate(path)) + sum(m[x, y] for x, y in zip(path, path[1:]))
                total.append(e)
                own = e if list(path) == gold[i, :lengths[i]].tolist() else own
            out += np.logaddexp.reduce(total) - own
        return out
    for x, g in zip((s, m, st), L._padded_gradient(s, gold, lengths, m, st)):
        for at in np.ndindex(*x.shape):
            x[at] += 1e-5
            up = loss(s, m, st)
            x[at] -= 2e-5
            down = loss(s, m, st)
            x[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_held_out_accuracy_and_code_switching(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_language_id"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    model = L.train_language_model(docs)
    de = docs.where("lang = 'de'").orderBy("doc_id").first().text.split()[:40]
    fr = docs.where("lang = 'fr'").orderBy("doc_id").first().text.split()[:40]
    scores, _, offsets = L._emissions([" ".join(de + fr)], model["weights"])
    path = L.posteriors(scores, offsets, model["transitions"], model["start"]).argmax(axis=1)
    names = [model["languages"][i] for i in path]
    assert names[:40].count("de") >= 36 and names[40:].count("fr") >= 36


def test_edge_cases(spark):
    docs = edge_docs(spark)
    model = L.train_language_model(docs)
    got = L.predict_languages(docs, model, keep=docs.columns).collect()
    assert len(got) == len(edge_rows())
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (0, 1, 2, 3, 13)] == [("und", 0.0)] * 5
    assert by_id[15].lang_pred in ("en", "fr")
    assert all(r.lang_pred == "und" for r in L.predict_languages(docs, None, keep=["doc_id"]).collect())
    assert L.train_language_model(empty_docs(spark)) is None
    assert L.predict_languages(empty_docs(spark), model, keep=["doc_id"]).collect() == []
    kept = keep_known_languages(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {4, 5, 8, 11, 15}
