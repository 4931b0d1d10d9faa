"""Filter interaction audit by count-weighted decision diagrams.

Each document gets a failure mask, one bit per filter.  Documents are counted by (part, mask):
at most 2**5 rows per part, partial aggregates, so a part with a third of all rows costs no
more than any other.  From a part's counts a shared decision diagram is built: one level per
filter, the low branch for documents that pass it, the high branch for those that fail, equal
subdiagrams kept once, and every node weighted by the documents below it.  Adjacent level swaps
take the diagram through all orders of the filters; in each order the path of low branches is
the filter chain: the weight of a low branch is what the step keeps, that of a high branch what
it removes.

A text copy is known by its SHA-256: the smallest id of each hash is a partial aggregate, and
the join back is on (hash, id), which no group of copies shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsmith.llm.common import WORD_PATTERN, stored

# The filters in order, with what fails them.
FILTERS = "ABCDE"
WORDS_LEAST, DISTINCT_PERCENT, CAPITALS_PERCENT, MARKS = 200, 50, 2, "[#$%&*|]"

_GAPS = WORD_PATTERN.replace("[^", "[", 1)
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic of every row: bit i of the mask is set if filter i fails.

    A null text is empty.  E fails if a smaller doc_id has the same text; a null doc_id has no
    smaller one and is none.  A label counts if any row of ``labels`` for the doc_id has it.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _GAPS), lambda w: w != "")
    read = docs.select(F.col("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), words.alias("words"))
    n = F.size("words")
    fails = [n < WORDS_LEAST, 100 * F.size(F.array_distinct("words")) < DISTINCT_PERCENT * n,
             100 * F.char_length(F.regexp_replace("text", "[^A-Z]+", "")) > CAPITALS_PERCENT * F.char_length("text"),
             F.col("text").rlike(MARKS)]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    rows = stored(read.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("hash")), "audit-masks")

    first = rows.where("doc_id IS NOT NULL").groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    marked = rows.join(first, ["hash", "doc_id"], "left")
    tags = (labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return marked.join(tags, "doc_id", "left").select(
        "part", (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


Counts = tuple[int, int, int]  # documents, good ones, toxic ones


class Diagram:
    """A count-weighted decision diagram with shared nodes; node numbers are keys of ``nodes``.

    Every path has all levels.  A leaf holds the counts of one mask; a node's weight is the sum
    of the leaves below it, over all paths.
    """

    def __init__(self, counts: dict[int, Counts], levels: int):
        self.order = list(range(levels))
        self.nodes: list[tuple] = []             # ("leaf", counts) or (variable, low, high)
        self.weights: list[Counts] = []
        self._known: dict[tuple, int] = {}
        row = [self._node(("leaf", counts.get(mask, (0, 0, 0)))) for mask in range(1 << levels)]
        for variable in reversed(range(levels)):  # the last level decides the highest bit
            row = [self._node((variable, row[i], row[i + (1 << variable)])) for i in range(1 << variable)]
        self.root = row[0]

    def _node(self, key: tuple) -> int:
        if key not in self._known:
            self._known[key] = len(self.nodes)
            self.nodes.append(key)
            self.weights.append(key[1] if key[0] == "leaf" else tuple(
                a + b for a, b in zip(self.weights[key[1]], self.weights[key[2]])))
        return self._known[key]

    def swap(self, level: int) -> None:
        """Exchange a level with the next one: only nodes of the two levels change."""
        upper, lower = self.order[level], self.order[level + 1]
        done: dict[int, int] = {}

        def exchanged(node: int) -> int:
            _, low, high = self.nodes[node]
            (_, pp, pf), (_, fp, ff) = self.nodes[low], self.nodes[high]
            return self._node((lower, self._node((upper, pp, fp)), self._node((upper, pf, ff))))

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                if depth == level:
                    done[node] = exchanged(node)
                else:
                    variable, low, high = self.nodes[node]
                    done[node] = self._node((variable, rebuilt(low, depth + 1), rebuilt(high, depth + 1)))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = lower, upper

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """(variable, weight that passes, weight that fails) along the path of all-pass branches."""
        node = self.root
        for variable in self.order:
            _, low, high = self.nodes[node]
            yield variable, self.weights[low], self.weights[high]
            node = low

    def only(self, variable: int) -> Counts:
        """Weight of the one path that fails ``variable`` alone."""
        node = self.root
        for at in self.order:
            node = self.nodes[node][2 if at == variable else 1]
        return self.weights[node]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places whose adjacent swaps, one after another, pass through all orders of n items.

    The last item walks from one end to the other; between two walks the others make a step.
    """
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from reversed(range(n - 1)) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step  # the walker stands in front of the others, or behind them
        down = not down


def _all_orders(pdf: pd.DataFrame) -> pd.DataFrame:
    """The steps of all orders for one part; ``pdf`` has a row per mask."""
    n = len(FILTERS)
    diagram = Diagram({m: (a, g, t) for m, a, g, t in zip(*(pdf[c].tolist() for c in ("mask", "n", "good", "toxic")))}, n)
    swaps, rows = adjacent_swaps(n), []
    # a filter at the top of the diagram removes all that fail it
    failing: dict[int, int] = {}
    while True:
        name = "".join(FILTERS[v] for v in diagram.order)
        for step, (variable, passed, failed) in enumerate(diagram.steps(), 1):
            if step == 1:
                failing[variable] = failed[0]
            rows.append([name, step, variable, passed[0], *failed])
        at = next(swaps, None)
        if at is None:
            break
        diagram.swap(at)
    out = pd.DataFrame(rows, columns=["filter_order", "step", "variable", "kept", "removed", "good_lost", "toxic_lost"])
    out["redundant"] = out["variable"].map(failing) - out["removed"]
    out["unique_fails"] = out["variable"].map({v: diagram.only(v)[0] for v in range(n)})
    out["shapley"] = out.groupby("variable")["removed"].transform("sum")
    out["part"] = pdf["part"].iloc[0]
    return out[[c.split()[0] for c in SCHEMA.split(", ")]]


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``SCHEMA``.

    A part is a value of ``source``; null and empty are one part, the empty string.  Counts of a
    step: kept after it, removed by it, redundant (failing its filter but removed before),
    unique_fails (failing this filter only), good_lost and toxic_lost (removed by it, with that
    label), shapley (its filter's removed, summed over all orders).  Repeated rows and repeated
    ids count a row each.  An empty table has no parts and gives no rows; other columns of both
    tables are ignored.
    """
    counts = failure_masks(docs, labels).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return counts.groupBy("part").applyInPandas(_all_orders, SCHEMA)
