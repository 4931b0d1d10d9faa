import random

from edge import edge_docs, edge_rows, empty_docs, words

from logsmith.llm import toxicity as X
from logsmith.llm.queries import QUERIES


def insulting(rng, n):
    w = words(rng, n)
    for i in range(rng.randrange(20), n, 30):
        w[i] = rng.choice(["blockhead", "numbskull", "nitwit"])
    return " ".join(w)


def test_learns_words_and_their_misspellings():
    rng = random.Random(1)
    toxic = [insulting(rng, rng.randrange(40, 300)) for _ in range(400)]
    clean = [" ".join(words(rng, rng.randrange(40, 300))) for _ in range(400)]
    model = X.fit_toxicity(toxic + clean, [1] * 400 + [0] * 400)
    held = [insulting(rng, 100) for _ in range(40)], [" ".join(words(rng, 100)) for _ in range(40)]
    bad, good = (X.score_texts(t, model) for t in held)
    assert (bad >= X.THRESHOLD).mean() >= 0.85 and (good >= X.THRESHOLD).mean() <= 0.05
    usual = " ".join(words(rng, 30))
    plain, odd = X.score_texts([usual + " zzyxq", usual + " nummbskulll"], model)
    assert odd > plain
    far = usual + " " + " ".join(words(rng, 3000)) + " blockhead"
    assert X.score_texts([far], model)[0] >= X.THRESHOLD  # whole texts, not prefixes


def test_query_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = sorted((rows[r.doc_id].score, r.toxic) for r in labels if r.toxic is not None and rows[r.doc_id].held_out)
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= X.THRESHOLD) for r in rows.values())
    ones = [i for i, (_, t) in enumerate(held) if t]
    n1, n0 = len(ones), len(held) - len(ones)
    assert (sum(ones) - n1 * (n1 - 1) / 2) / (n1 * n0) >= 0.85


def test_edge_cases(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(8, 1, 1), (9, 1, 0), (18, 0, 1), (19, 1, 0), (8, 1, None), (None, 1, 1), (4, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = X.train_toxicity_model(docs, labels)
    got = X.score_documents(docs, model, keep=docs.columns).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert X.train_toxicity_model(docs, labels.limit(0)) is None
    assert {r.score for r in X.score_documents(docs, None, keep=["doc_id"]).collect()} == {0.0}
    assert X.score_documents(empty_docs(spark), model, keep=["doc_id"]).collect() == []
