"""The audit against brute force over all orders."""

import itertools
import random
import re

from edge import edge_docs, edge_rows, empty_docs
from logsmith.llm.filter_audit import FILTERS, Diagram, adjacent_swaps, audit_filters

LABELS = "doc_id long, quality int, toxic int, source string, mask int"


def fails(text, words, copy):
    return {f for f, bad in zip(FILTERS, (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)), copy)) if bad}


def brute_audit(rows, labels):
    """rows of (doc_id, text, source), labels of (doc_id, quality, toxic) -> set of result rows."""
    rows = [(d, t or "", s or "") for d, t, s in rows]
    lowest = {}
    for d, t, _ in rows:
        if d is not None:
            lowest[t] = min(d, lowest.get(t, d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    judged = [(s, fails(t, re.findall(r"[^\x20\x09-\x0D]+", t), d is not None and lowest[t] < d), d) for d, t, s in rows]
    out, shares = [], {}
    for part in {s for s, _, _ in judged}:
        mine = [(f, d) for s, f, d in judged if s == part]
        for order in itertools.permutations(FILTERS):
            left = mine
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                failing = sum(letter in f for f, _ in mine)
                shares[part, letter] = shares.get((part, letter), 0) + len(removed)
                out.append((part, "".join(order), step, len(left), len(removed), failing - len(removed),
                            sum(f == {letter} for f, _ in mine), sum(d in good for _, d in removed),
                            sum(d in toxic for _, d in removed), letter))
    return sorted(r[:-1] + (shares[r[0], r[-1]],) for r in out)


def test_swaps_pass_through_all_orders_and_keep_the_function():
    rng = random.Random(2)
    for n in range(1, 7):
        counts = {m: (rng.randrange(4), rng.randrange(3), rng.randrange(2)) for m in range(1 << n) if rng.random() < 0.7}
        diagram = Diagram(counts, n)
        seen = {tuple(diagram.order)}
        for at in adjacent_swaps(n):
            diagram.swap(at)
            seen.add(tuple(diagram.order))
            before = 0
            for variable, kept, removed in diagram.steps():
                assert kept[0] == sum(c[0] for m, c in counts.items() if not m & (before | 1 << variable))
                assert removed[2] == sum(c[2] for m, c in counts.items() if not m & before and m >> variable & 1)
                before |= 1 << variable
            assert diagram.only(0) == counts.get(1, (0, 0, 0))
        assert seen == set(itertools.permutations(range(n)))


def test_equal_subdiagrams_are_shared():
    flat = Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(flat.nodes) == 6 and flat.weights[flat.root] == (32, 0, 0)


def test_audit_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    vocabulary = [f"w{i}" for i in range(500)]
    for i in range(60):
        words = [rng.choice(vocabulary[:rng.choice([3, 500])]) for _ in range(rng.choice([5, 199, 200, 260]))]
        if rng.random() < 0.3:
            words.append("SHOUTING " * 30)
        if rng.random() < 0.3:
            words.append(rng.choice("#$%&*|"))
        rows.append((100 + i, " ".join(words), rng.choice(["s1", "s9", None, ""])))
    rows += [(rng.randrange(100, 200), rows[-1][1], "s9") for _ in range(20)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), "clash", 9) for i in range(90, 180)] + [(None, 1, 1, None, None)]
    labels += labels[:30]
    docs = spark.createDataFrame([(d, t, s, 1, "clash", 5) for d, t, s in rows],
                                 "doc_id long, text string, source string, mask int, part string, hash int").repartition(3)
    got = audit_filters(docs, spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, [x[:3] for x in labels])


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert audit_filters(empty_docs(spark), labels).count() == 0
    assert audit_filters(edge_docs(spark), labels).agg({"toxic_lost": "sum"}).first()[0] == 0
