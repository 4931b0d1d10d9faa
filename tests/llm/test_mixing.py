import random
from collections import Counter

from edge import edge_docs, edge_rows, empty_docs, words
from pyspark.sql import functions as F

from logsmith.llm.mixing import mix_documents, mix_plan, split_quotas


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling, by taking and resharing the excess until none is left."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s]]
        if not over:
            return capped | shares
        capped |= {s: most * sizes[s] for s in over}


def corpus(seed=2):
    rng = random.Random(seed)
    rows, n = [], 0
    for s, docs in [("b", 400), ("a", 60), (None, 30), ("Z", 25), ("é", 3), ("hot", 900)]:
        for _ in range(docs):
            rows.append((n, " ".join(words(rng, rng.randrange(1, 60))), s))
            n += 1
    return rows


def test_targets_and_takes(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    plan = mix_plan(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    expected = targets(sizes)
    taken = Counter()
    for r in plan:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 * expected[r.source]
        assert r.taken == r.size * len(r.shards) <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 60
    again = mix_plan(df.repartition(3)).collect()
    pick = lambda p: sorted((r.doc_id, r.taken, r.shards) for r in p)
    assert pick(plan) == pick(again)
    mixed = mix_documents(df)
    assert mixed.count() == sum(len(r.shards) for r in plan)
    per_shard = {r.shard: r.n for r in mixed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(per_shard) == 16


def test_splitting_tree_keeps_quotas(spark):
    quotas = {1: 1000, 2: 37, 3: 0, 4: 5}
    df = spark.createDataFrame(list(quotas.items()), "source_no long, n long")
    leaves = split_quotas(df, 6).collect()
    by_source, by_shard = Counter(), Counter()
    for r in leaves:
        assert r.n >= 0
        by_source[r.source_no] += r.n
        by_shard[r.shard] += r.n
    assert all(by_source[k] == v for k, v in quotas.items())
    assert len(by_shard) == 6 and max(by_shard.values()) - min(by_shard.values()) <= 2


def test_edge_cases(spark):
    docs = edge_docs(spark)
    plan = mix_plan(docs).collect()
    assert sum(r.copies for r in plan) == len(edge_rows())
    assert all(r.taken == 0 for r in plan if r.size == 0)
    mixed = mix_documents(docs)
    assert set(docs.columns) <= set(mixed.columns)
    assert mixed.count() == sum(len(r.shards) * r.copies for r in plan)
    assert mix_plan(empty_docs(spark)).collect() == [] and mix_documents(empty_docs(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, "s"), (2, "", "s")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mix_plan(blank).collect()] == [(0.0, 0)] * 2


def test_later_documents_fill_behind_a_long_one(spark):
    rng = random.Random(6)
    rows, n = [], 0
    for s in ("a", "b", "c", "d"):
        for _ in range(400):
            rows.append((n, " ".join(words(rng, rng.randrange(1, 60))), s))
            n += 1
        rows.append((n, "w " * 9_000, s))
        n += 1
    plan = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    for s in ("a", "b", "c", "d"):
        own = [r for r in plan if r.source == s]
        epochs = int(own[0].target // own[0].source_size)
        room = own[0].target - sum(r.taken for r in own)
        # no document that was left out fits into what is left
        assert 0 <= room < min((r.size for r in own if len(r.shards) == epochs), default=10**9)
