import random

import numpy as np
from edge import edge_docs, edge_rows, empty_docs, words

from logsmith.llm import substring_dedup as S
from logsmith.llm.substring_dedup import MIN_WORDS, cut_words, remove_repeats


def windows(text, n=MIN_WORDS):
    w = (text or "").lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def test_spliced_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(8)
    passage = words(rng, 57)
    rows, clean = [], {}
    for i in range(40):
        own = words(rng, rng.randrange(60, 200), 10**6)
        if i % 2:
            at = rng.randrange(len(own))
            own[at:at] = passage
            rows.append((i, " ".join(own)))
        else:
            own += words(rng, 12, 3)  # short repeats are no passages
            clean[i] = " ".join(own)
            rows.append((i, clean[i]))
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[i].text == t and got[i].removed_words == 0 for i, t in clean.items())
    holders = [i for i, r in got.items() if tuple(passage) in windows(r.text, len(passage))]
    assert holders == [1]
    assert all(got[i].removed_words >= 57 for i in range(3, 40, 2))
    seen = set()
    for r in got.values():
        assert not seen & windows(r.text)
        seen |= windows(r.text)


def test_near_paragraphs_form_components(spark):
    rng = random.Random(9)
    base = words(rng, 120)
    rows = [(0, "\n".join([" ".join(words(rng, 30, 10**6)), " ".join(base)]))]
    for i in range(1, 6):
        near = list(base)
        near[7 * i], near[60 + 7 * i] = "changed%d" % i, "altered%d" % i   # J = 100 / 132 with the base
        rows.append((i, "\n".join([" ".join(words(rng, 30, 10**6)), " ".join(near)])))
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].removed_words == 0
    assert all(got[i].removed_words == 120 for i in range(1, 6))


def test_cut_keeps_the_rest():
    assert cut_words("a b\nc d  e", [(1, 3)]) == ("a d  e", 2)
    assert cut_words("a b\nc d  e", [(3, 9)]) == ("a b\nc", 2)
    assert cut_words("é b c", [(0, 1), (0, 2)]) == ("c", 2)


def test_edge_cases(spark):
    docs = edge_docs(spark)
    out = remove_repeats(docs)
    assert set(docs.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[0][0].text is None and by_id[1][0].text == "" and by_id[2][0].text == "   "
    same = [r.text for r in by_id[8] if "another" not in (r.text or "")]
    assert len(same) == 3 and len(set(same)) == 1
    assert by_id[9][0].text == "" and by_id[9][0].removed_words == 80
    assert remove_repeats(empty_docs(spark)).collect() == []


def test_passages_that_the_lowest_holder_shares_too_little_of(spark):
    rng = random.Random(12)
    passages, rows = [], []
    for k in range(20):
        passage = words(rng, 51, 10**6)
        passages.append(passage)
        for i, part in enumerate([passage[:49], passage, passage, passage]):
            rows.append((4 * k + i, " ".join(words(rng, 60, 10**6) + part + words(rng, 60, 10**6))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    for k, passage in enumerate(passages):
        assert [tuple(passage) in windows(got[4 * k + i].text, 51) for i in range(4)] == [False, True, False, False]
        assert [got[4 * k + i].removed_words for i in range(4)] == [0, 0, 51, 51]


def test_near_paragraphs_whose_lowest_partner_is_not_similar(spark):
    rng = random.Random(13)
    rows = []
    for k in range(6):
        base = words(rng, 120, 10**6)
        middle = list(base)
        middle[60] = "changed"                                            # J = 111 / 121 with the base
        lows = [[w if j < 88 else words(rng, 1, 10**6)[0] for j, w in enumerate(base)] for _ in range(30)]  # J about 0.57
        rows += [" ".join(t) for t in [*lows, base, middle]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.removed_words for r in remove_repeats(df).collect()}
    assert all(got[32 * k + 31] == 120 for k in range(6))


def test_near_paragraphs_whose_lowest_holder_is_unlike_them(spark, monkeypatch):
    """One paragraph with a few words changed in each document: all but one go, by pairs that grow with their number."""
    from logsmith.llm import substring_dedup as D
    pairs = {}
    for n in (40, 160):
        rng = random.Random(n)
        base = [f"w{i}" for i in range(90)]

        def changed(edits):
            w = list(base)
            for at in rng.sample(range(90), edits):
                w[at] = f"new{rng.randrange(10**9)}"
            return " ".join(w)
        rows = [(i, changed(4)) for i in range(10)] + [(i + 10, changed(1)) for i in range(n)]
        seen, plain = [], D.stored

        def counted(df, name):
            out = plain(df, name)
            if name in ("paragraph-met", "repeat-pairs"):
                seen.append(out.count())
            return out
        with monkeypatch.context() as m:
            m.setattr(D, "stored", counted)
            out = {r.doc_id: r.text for r in D.remove_repeats(
                spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
        copies = [out[i + 10] for i in range(n)]
        assert sum(bool(t.strip()) for t in copies) <= 1
        pairs[n] = sum(seen)
    assert pairs[160] <= 6 * pairs[40]


def test_marks_never_refuse_similar_paragraphs(spark):
    rng = np.random.default_rng(5)
    common = np.unique(rng.integers(1, 2 ** 63, 4000)).astype(np.uint64)
    texts, rows = [], []
    for n in (50, 80, 300, 1500):
        base = common[:n]
        for k in (0, 1, n // 60, n // 40, n // 25, n // 8, n):
            other = base.copy()
            other[rng.permutation(n)[:k]] = rng.integers(1, 2 ** 63, k).astype(np.uint64)
            texts.append((base, other))
    words = np.concatenate([w for pair in texts for w in pair])
    bounds = np.cumsum([0, *(len(w) for pair in texts for w in pair)])
    sizes, wide = S.shingle_marks(words, bounds[:-1], bounds[1:])
    refused = {}
    for name, bitmap in (("narrow", S.narrowed(wide)), ("wide", wide)):
        width = bitmap.shape[1]
        marks = [tuple(int(v) for v in (n, *b.astype(np.int64))) for n, b in zip(sizes, bitmap)]
        df = spark.createDataFrame([(i, marks[2 * i], marks[2 * i + 1]) for i in range(len(texts))],
                                   f"i int, x {S._marks_type(width)}, y {S._marks_type(width)}")
        got = {r.i: r.ok for r in df.select("i", S.may_be_similar(df.x, df.y, width).alias("ok")).collect()}
        assert all(got[i] for i, (a, b) in enumerate(texts) if S.similar(a, b))
        refused[name] = sum(not ok for ok in got.values())
    unlike = sum(not S.similar(a, b) for a, b in texts)
    assert 0 < refused["narrow"] <= refused["wide"] <= unlike


def test_shared_runs_are_the_maximal_equal_runs_at_the_seeds_offsets(monkeypatch):
    rng = np.random.default_rng(6)
    for cells in (1, 500, S.RUN_CELLS):
        monkeypatch.setattr(S, "RUN_CELLS", cells)
        for same in (False, True):
            b = np.concatenate([np.tile(rng.integers(0, 99, 7), 30), rng.integers(0, 99, 150), np.arange(60)]).astype(np.uint64)
            a = b if same else np.concatenate([b[5:260], rng.integers(0, 99, 20).astype(np.uint64), b[300:]])
            seeds = {(int(p), int(q)) for p, q in zip(rng.integers(0, len(a) - 20, 400), rng.integers(0, len(b) - 20, 400))
                     if (a[p:p + 20] == b[q:q + 20]).all()} | {(0, 5), (len(a) - 60, len(b) - 60)}
            expected = set()
            for p, q in seeds:
                if (a[p:p + 20] != b[q:q + 20]).any() or same and q >= p:
                    continue
                s, e = p, p
                while s and q - p + s and a[s - 1] == b[s - 1 + q - p]:
                    s -= 1
                while e < len(a) and e + q - p < len(b) and a[e] == b[e + q - p]:
                    e += 1
                if e - s >= MIN_WORDS:
                    expected.add((s, e))
            place, low = (np.array(x, dtype=np.int64) for x in zip(*sorted(seeds)))
            first, end = S.shared_runs(a, b, place, low, same)
            assert sorted(expected) == list(zip(first.tolist(), end.tolist())) and expected


def test_what_is_left_meets_in_one_round_and_leaves_one_scratch_table(spark, monkeypatch):
    """Four unlike paragraphs that share values with many near ones: no round for each width, no scratch but the spans."""
    from logsmith import scratch
    rng = random.Random(21)
    rows = []
    for k in range(12):
        base = words(rng, 120, 10**6)
        middle = list(base)
        middle[60] = "changed"                                            # J = 111 / 121 with the base
        lows = [[w if j < 88 else words(rng, 1, 10**6)[0] for j, w in enumerate(base)] for _ in range(30)]
        rows += [" ".join(t) for t in [*lows, base, middle]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    seen, plain = [], S.stored

    def counted(frame, name):
        seen.append(name)
        return plain(frame, name)
    monkeypatch.setattr(S, "stored", counted)
    before = len(scratch._tables)
    got = {r.doc_id: r.removed_words for r in remove_repeats(df).collect()}
    assert all(got[32 * k + 31] == 120 for k in range(12))
    assert seen.count("paragraph-met") <= 2
    assert [path.rsplit("/", 1)[1].startswith("repeat-spans") for _, path in scratch._tables[before:]] == [True]
