import random
import re

from edge import edge_docs, edge_rows, empty_docs, words

from logsmith.llm.ngram_join import keep_one_per_group, ngram_jaccard_join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    low = {r: min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for r, g in groups.items()}
    return [(rows[i][0], len(sets[i]), low[find(i)]) for i in range(len(rows))], groups


def hard_rows(seed):
    """Near copies of one text, a chain of shifts, and texts that share a passage."""
    rng = random.Random(seed)
    base, texts = words(rng, 60), []
    for _ in range(50):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = words(rng, 1)[0]
        texts.append(" ".join(w))
    w = words(rng, 40)
    for _ in range(30):
        w = w[1:] + words(rng, 1)
        texts.append(" ".join(w))
    texts += [" ".join(base[:20] + words(rng, rng.randrange(1, 12))) for _ in range(25)] + texts[:5]
    rng.shuffle(texts)
    return list(enumerate(texts))


def key(rows):
    return sorted(rows, key=str)


def test_components_equal_brute_force(spark):
    rows = hard_rows(4)
    got = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    expected, groups = brute_force(rows)
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(expected)
    kept = keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(groups)


def test_edge_cases(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = ngram_jaccard_join(edge_docs(spark)).collect()
    expected, _ = brute_force(rows)
    expected = [(i, n, c if n else i) for i, n, c in expected]
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(expected)
    kept = keep_one_per_group(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    texts = [r.text for r in kept.collect()]
    assert sum(t is None or not t.strip() for t in texts) == sum(t is None or not t.strip() for _, t in rows)
    full = [t for t in texts if t and t.strip()]
    assert len({shingles(t) for t in full}) == len(full)


def test_empty_table(spark):
    assert ngram_jaccard_join(empty_docs(spark)).collect() == []
    assert keep_one_per_group(empty_docs(spark)).collect() == []


def test_repeated_rows_are_fetched_once(spark, monkeypatch):
    from logsmith.llm import ngram_join
    base = ["word%d" % i for i in range(60)]
    near = [*base[:59], "other"]
    rows = [(1, " ".join(base))] * 5 + [(2, " ".join(near))] * 5
    fetched, stored = [], ngram_join.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "ngram-texts":
            fetched.append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "stored", counted)
    ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert fetched and set(fetched) == {2}


def near_copies(n, odd, seed=9):
    """n copies of one text with one word changed, which link with each other, and ``odd`` with three, which do not."""
    rng = random.Random(seed)
    base = words(rng, 80)

    def changed(edits):
        w = list(base)
        for at in rng.sample(range(6, 74), edits):
            w[at] = f"new{rng.randrange(10**9)}"
        return " ".join(w)
    texts = [changed(1) for _ in range(n)] + [changed(3) for _ in range(odd)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def chain(n, seed=3):
    """Each text is the one before with one word changed: only neighbours in the chain link."""
    rng = random.Random(seed)
    w, texts = words(rng, 60), []
    for i in range(n):
        w[(7 * i) % 60] = f"step{i}"
        texts.append(" ".join(w))
    rng.shuffle(texts)
    return list(enumerate(texts))


def joined_with_counts(spark, rows, monkeypatch):
    from logsmith.llm import ngram_join
    counts, stored = {}, ngram_join.stored

    def counted(df, name):
        out = stored(df, name)
        counts.setdefault(name, []).append(out.count() if name in ("ngram-pairs", "ngram-open") else 0)
        return out
    with monkeypatch.context() as m:
        m.setattr(ngram_join, "stored", counted)
        got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    return key((r.doc_id, r.n_shingles, r.component_id) for r in got), counts


def test_chained_copies_equal_brute_force(spark, monkeypatch):
    rows = chain(300) + [(i + 1000, t) for i, t in near_copies(60, 20)]
    got, counts = joined_with_counts(spark, rows, monkeypatch)
    assert got == key(brute_force(rows)[0])
    assert len(counts["ngram-open"]) > 1                      # it took rounds


def test_pairs_grow_with_the_copies_not_with_their_square(spark, monkeypatch):
    pairs = {}
    for n in (150, 600):
        rows = near_copies(n, 10)
        got, counts = joined_with_counts(spark, rows, monkeypatch)
        assert got == key(brute_force(rows)[0])
        pairs[n] = sum(counts["ngram-pairs"])
    assert pairs[600] <= 5 * pairs[150]
