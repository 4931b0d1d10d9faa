import hashlib
import random

from edge import edge_docs, edge_rows, empty_docs, words

from logsmith.llm import fingerprint as P


def test_counts_are_those_of_all_triplets(monkeypatch):
    monkeypatch.setattr(P, "CHUNK_BYTES", 50)
    rng = random.Random(2)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 3, 10, 49, 50, 51, 52, 120, 333)]
    got = P.bucket_counts(texts)
    import numpy as np
    for t, row in zip(texts, got):
        want = np.zeros(P.BUCKETS, int)
        for i in range(len(t) - 2):
            want[int(P.ngram_slots(np.frombuffer(t[i:i + 3], np.uint8), 3, P.BUCKET_BITS)[0])] += 1
        assert row.tolist() == want.tolist()


def test_likeness_is_bounded_and_orders_edits():
    rng = random.Random(3)
    text = " ".join(words(rng, 400))
    w = text.split()
    w[10] = "edited"
    near, other = " ".join(w), " ".join(words(rng, 400))
    a, b, c = P.fingerprint_texts([text, near, other])
    assert P.fingerprint_likeness(a, a) == 1.0
    assert 1.0 > P.fingerprint_likeness(a, b) > 0.8 > P.fingerprint_likeness(a, c) >= 0.0
    assert P.fingerprint_likeness(a, b) == P.fingerprint_likeness(b, a)


def check(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    by_id = {r.doc_id: r for r in got}
    for i, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = by_id[doc]
        prints = P.fingerprint_texts([text, edited, following])
        assert r.n_chars == len(text) and [r.fingerprint, r.edited_fingerprint] == prints[:2]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - P.fingerprint_likeness(*prints[:2])) < 1e-12
        assert abs(r.near_next - P.fingerprint_likeness(prints[0], prints[2])) < 1e-12


def test_next_documents_across_partitions(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(50))) + "é" * (i % 3)) for i in rng.sample(range(1000), 200)] + [(None, "last")]
    got = P.fingerprints_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_edge_cases(spark):
    got = P.fingerprints_with_next(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert len({r.fingerprint for r in got if r.doc_id in (0, 1)}) == 1
    assert P.fingerprints_with_next(empty_docs(spark)).collect() == []
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    check([(5, "abcd")], P.fingerprints_with_next(one).collect())
