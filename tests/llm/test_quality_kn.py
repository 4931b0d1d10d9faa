import math
import random
from collections import Counter

from edge import edge_docs, edge_rows, empty_docs

from logsmith.llm import quality_kn as K


def brute_force(texts):
    """Interpolated modified Kneser-Ney by its formulas, over dictionaries."""
    top = Counter()
    for t in texts:
        for w in (t or "").split():
            top.update(K.word_grams(w))
    counts = {K.ORDER: {g: n for g, n in top.items() if len(g) == K.ORDER}}
    for k in range(K.ORDER - 1, 0, -1):
        c = Counter(g[1:] for g in counts[k + 1])
        c.update({g: n for g, n in top.items() if len(g) == k})
        counts[k] = dict(c)
    base = 1 / (len(counts[1]) + 1)
    cuts = {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else None
        cuts[k] = [0.5] * 3 if y is None else [
            min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i * y, 0.05), i - 0.05) for i in (1, 2, 3)]

    def p(gram):
        k = len(gram)
        lower = base if k == 1 else p(gram[1:])
        same = {g: n for g, n in counts[k].items() if g[:-1] == gram[:-1]}
        if not same:
            return lower
        cut = lambda n: cuts[k][min(n, 3) - 1]
        total = sum(same.values())
        own = same.get(gram, 0)
        return ((own - cut(own)) if own else 0) / total + sum(map(cut, same.values())) / total * lower
    return p


def test_perplexities_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    model = K.train_ngram_model(df.where("doc_id < 40"))
    p = brute_force(texts[:40])
    for r in K.document_perplexities(df, model, ["doc_id"]).collect():
        grams = [g for w in texts[r.doc_id].split() for g in K.word_grams(w)]
        assert r.n_symbols == len(grams)
        expected = math.exp(-sum(math.log(p(g)) for g in grams) / len(grams))
        assert abs(r.perplexity - expected) < 1e-6 * expected


def test_probabilities_sum_to_one(spark):
    texts = ["abab abba baab", "ab ba a b", "bbb aab"]
    p = brute_force(texts)
    symbols = ["a", "b", K.END]
    for context in ("", "a", "ab", K.BEGIN, K.BEGIN + "ab"):
        assert sum(p(context + s) for s in symbols) <= 1 + 1e-9


def test_keeps_trusted_and_drops_junk(spark):
    rows = [(i, "the reader of the other thing was there with the answer " * 3, "en") for i in range(50)]
    rows += [(100, "x9#k!!zq @@@@ wwwwww $$%%^ zzzqqq", "en"), (101, "the thing of the reader", None), (102, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in K.classify_quality(docs, labels).collect()}
    assert all(got[i].keep for i in range(50)) and not got[100].keep and not got[102].keep
    assert got[102].perplexity is None and got[101].threshold == got[0].threshold


def test_edge_cases(spark):
    labels = spark.createDataFrame([(8, 1, 0), (None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    got = K.classify_quality(edge_docs(spark), labels).collect()
    assert len(got) == len(edge_rows())
    assert all((r.perplexity is None) == (r.n_symbols == 0) for r in got)
    none = K.classify_quality(edge_docs(spark), labels.limit(0)).collect()
    assert all(r.keep == (r.n_symbols > 0) for r in none)
    assert K.classify_quality(empty_docs(spark), labels).collect() == []


def sentences(seed, n):
    """Texts in which every word calls for one of two next words."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    vocabulary = sorted(set(vocabulary))
    after = {w: rng.sample(vocabulary, 2) for w in vocabulary}
    texts = []
    for _ in range(n):
        words = [rng.choice(vocabulary)]
        while len(words) < 120:
            words.append(rng.choice(after[words[-1]]))
        texts.append(words)
    return texts


def test_repeated_and_shuffled_words_are_dropped(spark):
    texts = sentences(3, 140)
    rng = random.Random(8)
    rows = [(i, " ".join(t), "en") for i, t in enumerate(texts)]
    rows += [(200 + i, " ".join(w for w in t[:12] for _ in range(10)), "en") for i, t in enumerate(texts[100:120])]
    rows += [(300 + i, " ".join(rng.sample(t, len(t))), "en") for i, t in enumerate(texts[120:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    got = {r.doc_id: r.keep for r in K.classify_quality(docs, labels).collect()}
    assert sum(got[i] for i in range(140)) >= 136
    assert not any(got[i] for i in got if i >= 200)


def test_trusted_texts_are_scored_without_their_own_pairs(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["ab", "ba", "abc", "c", "cab", "bb"]) + rng.choice(["", "a", "q"])
                      for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    trusted = set(range(25))
    docs = spark.createDataFrame([(i, t, i in trusted) for i, t in enumerate(texts)], "doc_id long, text string, trusted boolean")
    read = docs.where("trusted")
    model, words = K.train_ngram_model(read), K.train_word_model(read)
    spell = brute_force([texts[i] for i in sorted(trusted)])
    pairs_of = lambda t: list(zip([None] + t.split(), t.split()))
    for r in K.document_perplexities(docs.repartition(3), model, ["doc_id", "trusted"], words).collect():
        pairs = Counter(x for i in trusted if i != r.doc_id for x in pairs_of(texts[i]))
        follows = Counter(w for _, w in pairs)
        cut = lambda n, d: d[min(n, 3) - 1] if n else 0.0
        logp = 0.0
        for v, w in pairs_of(texts[r.doc_id]):
            p = math.exp(sum(math.log(spell(g)) for g in K.word_grams(w)))
            n = sum(follows.values())
            p = (follows[w] - cut(follows[w], words["of_words"]) + sum(cut(x, words["of_words"]) for x in follows.values()) * p) / n
            same = {b: c for (a, b), c in pairs.items() if a == v}
            if same:
                own = same.get(w, 0)
                p = (own - cut(own, words["of_pairs"]) + sum(cut(x, words["of_pairs"]) for x in same.values()) * p) / sum(same.values())
            logp += math.log(p)
        expected = math.exp(-logp / r.n_symbols)
        assert abs(r.perplexity - expected) < 1e-6 * expected


def test_training_leaves_only_the_tables_of_the_models(spark):
    from logsmith import scratch
    texts = spark.createDataFrame([("ab abc ab ba",), ("ba ab cab",), (None,)], "text string")
    before = len(scratch._tables)
    model, words = K.train_ngram_model(texts), K.train_word_model(texts)
    left = sorted(path.rsplit("/", 1)[1].rsplit("-", 1)[0] for _, path in scratch._tables[before:])
    assert left == sorted([f"kn-{what}-{k}" for what in ("p", "backoff") for k in range(1, K.ORDER + 1)] + ["kn-word-counts"])
    assert all(table.count() for table in [*model["p"].values(), *model["backoff"].values(), words["counts"]])


def random_texts(seed, n, words):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("abcdeé日") for _ in range(rng.randrange(1, 6))) for _ in range(words)) for _ in range(n)]


def test_pairs_travel_packed(spark, monkeypatch):
    rows, write = {}, K.stored

    def counted(df, name):
        table = write(df, name)
        rows[name] = table.count()
        return table
    monkeypatch.setattr(K, "stored", counted)
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(random_texts(6, 30, 200))], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    assert K.classify_quality(docs, labels).count() == 30
    # 2,400 pairs of words are trusted; neither these nor words or their n-grams in documents have a row each
    trained = {"kn-raw", *(f"kn-{what}-{k}" for what in ("p", "backoff") for k in range(1, K.ORDER + 1))}
    assert max(n for name, n in rows.items() if name not in trained) < 100


def test_many_blocks_of_files_give_the_rows_of_one(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = [(i, rng.choice(["en", "fr", None]), t) for i, t in enumerate(random_texts(3, 300, 20))]
    rows += [(0, "en", rows[5][2]), (None, "en", rows[7][2]), (301, "fr", ""), (302, "en", None), *rows[:9]]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(250)], "doc_id long, quality int")
    spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    key = lambda r: (str(r.doc_id), str(r.lang), r.n_symbols, r.keep, round(r.perplexity or 0, 8), round(r.threshold, 8))
    one = sorted(map(key, K.classify_quality(docs, labels).collect()))
    assert len(one) == len(rows)
    for chars in (9_000, 400):  # a few units to a block; and units dealt out by hash
        monkeypatch.setattr(K, "BLOCK_CHARS", chars)
        assert K._in_blocks(docs.select("*", K._positions(docs).alias("at")))[0].select("block").distinct().count() > 2
        assert sorted(map(key, K.classify_quality(docs, labels).collect())) == one
