"""Periodic runs against brute force over all lags and places."""

import hashlib
import random
import re
import zlib

import numpy as np

import duckdb
from edge import edge_docs, empty_docs
from logsmith.llm.periodic_runs import collapse_runs, word_runs
from logsmith.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_runs(words):
    """Maximal stretches of each lag, longest enough, whose lag is their smallest period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - i + q
            if length >= max(6, 4 * q):
                part = words[i:i + length]
                if not any(all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_runs_equal_brute_force():
    rng = random.Random(5)
    for trial in range(400):
        words = []
        while len(words) < rng.choice([0, 3, 6, 20, 90, 200]):
            kind = rng.random()
            if kind < 0.5:
                words += [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 12))]
            else:
                unit = [rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.randrange(1, 14))]
                size = rng.randrange(1, 6 * len(unit) + 2)
                words += (unit * 7)[:size]
        got = [tuple(r) for r in word_runs(np.array(words, np.int64), np.zeros(len(words), np.int64)).tolist()]
        assert got == brute_runs(words), (trial, words)


def test_runs_stay_inside_their_documents():
    words = np.array([1, 1, 1, 1, 1, 1, 1, 1, 1, 1])
    docs = np.array([0, 0, 0, 0, 0, 1, 1, 1, 1, 1])
    apart = docs * 100 + words
    assert word_runs(apart, docs).tolist() == []
    assert word_runs(words, np.zeros(10, np.int64)).tolist() == [[0, 10, 1]]


def test_long_repeats_make_few_extensions():
    """20,000 equal words, and a word square of period 5,000: exact, without all pairs of occurrences."""
    same = np.zeros(20_000, np.int64)
    assert word_runs(same, same).tolist() == [[0, 20_000, 1]]
    unit = np.random.default_rng(1).integers(0, 50, 5_000)
    assert word_runs(np.tile(unit, 5), np.zeros(25_000, np.int64)).tolist() == [[0, 25_000, 5_000]]


def test_edge_documents(spark):
    docs = edge_docs(spark)
    extra = spark.createDataFrame([(99, "\tx  a b c a b c\na b c a b c y " + "z " * 9, None, None, None, None, None, None,
                                    None, None)], docs.schema)
    got = collapse_runs(docs.unionByName(extra), keep=("doc_id", "score")).collect()
    by_words = {}
    for r in docs.unionByName(extra).select("doc_id", "text").collect():
        words = split(r.text)
        runs = brute_runs(words) if len(words) < 500 else []
        by_words.setdefault((r.doc_id, len(words)), []).append((runs, brute_collapsed(words, runs)))
    assert len(got) == docs.count() + 1
    for r in got:
        assert ([tuple(x) for x in r.runs], r.text) in by_words[(r.doc_id, r.n_words)]
    assert collapse_runs(empty_docs(spark)).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words, h = split(text), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 1500:
            continue
        runs, r = brute_runs(words), got[doc_id]
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[1] * 1000 // x[2], x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert planted > 5
