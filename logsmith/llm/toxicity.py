"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its hashed parts: the whole word and its
character n-grams (3 to 5 bytes, word boundaries included).  A passage's vector is the mean
over its words, and a softmax over two classes reads it.  Embeddings and softmax are trained
jointly in numpy, so a misspelling never seen still shares most of its n-gram vectors with
the words it comes from.

A text is scored in passages of PASSAGE_WORDS words (all of them, whatever its length), as a
few toxic words would drown in the mean of a long text; the text's score is that of its most
toxic passage.  The mean of a passage is over its PASSAGE_WORDS places, where a word that
comes again, or a place that a short text leaves empty, adds nothing: repetition and
shortness move no score.  Training alternates accordingly: a toxic text teaches through the passage the
current model finds most toxic, a clean one through all of its passages' worst.

The sample is bounded: SAMPLE_DOCS labelled texts per class, those of lowest id hash.  All
scoring covers whole texts of all rows.  Because embedding and softmax are linear, a trained
model is one number per slot, and scoring is a sum over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsmith.llm.common import crc_of_id, small_arrow_batches
from logsmith.llm.words import _hash_words, distinct_words, ngram_slots, word_sums

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
SAMPLE_DOCS = 1000
SLOT_BITS, DIM = 17, 4
NGRAMS = (3, 4, 5)
PASSAGE_WORDS = 40
ROUNDS, STEPS, RATE, DECAY, FLOOR = 6, 15, 0.3, 1e-7, 0.05


def _parts(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each kind of word part: slots, and per word the first slot and their number."""
    for n in NGRAMS:
        if len(folded) >= n:
            yield ngram_slots(folded, n, SLOT_BITS), starts - 1, np.maximum(ends - starts + 3 - n, 0)
    words = _hash_words(folded, starts, ends) >> np.uint64(64 - SLOT_BITS)
    yield words ^ np.uint64(0x1B873), np.arange(len(starts)), np.ones(len(starts), dtype=np.int64)


def _passages(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds in words, text of each) of the passages of all texts; the last of a text is the
    shortest, and joins the one before it when it has less than half the words."""
    bounds, owner = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if a < b:
            cuts = list(range(a, b, PASSAGE_WORDS))
            if len(cuts) > 1 and b - cuts[-1] < PASSAGE_WORDS // 2:
                cuts.pop()
            bounds += cuts
            owner += [i] * len(cuts)
    return np.array([*bounds, offsets[-1]], dtype=np.int64), np.array(owner, dtype=np.int64)


def _bags(inverse: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words, their bounds) of each passage."""
    passage = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    both = np.unique((passage << 32) | inverse)
    return both & 0xFFFFFFFF, np.searchsorted(both >> 32, np.arange(len(bounds)))


class _Rows:
    """Sparse rows: items[bounds[i]:bounds[i + 1]], weighted by one over their number or over ``places``."""

    def __init__(self, items, bounds, places=None):
        self.items, self.bounds = items, bounds
        self.count = np.diff(bounds)
        self.scale = 1.0 / np.maximum(self.count, 1) if places is None else np.full(len(self.count), 1.0 / places)

    def _at(self, rows):
        """The chosen rows' items, or all of them for None."""
        if rows is None:
            return slice(None), self.bounds[:-1], self.count, self.scale
        count = self.count[rows]
        first = np.cumsum(count) - count
        return np.arange(count.sum()) + np.repeat(self.bounds[rows] - first, count), first, count, self.scale[rows]

    def mean(self, values, rows=None):
        at, first, count, scale = self._at(rows)
        return word_sums(values[self.items[at]], first, count) * scale[:, None]

    def back(self, grad, size, rows=None):
        at, _, count, scale = self._at(rows)
        used, scaled = self.items[at], grad * scale[:, None]
        return np.stack([np.bincount(used, np.repeat(scaled[:, j], count), minlength=size)
                         for j in range(grad.shape[1])], axis=1).astype(np.float32)


def fit_toxicity(texts: list[str | None], labels: list[int], seed: int = 5) -> dict:
    """{"slots": a logit per slot, "bias": ...} from labelled texts; deterministic."""
    rng = np.random.default_rng(seed)
    folded, starts, ends, inverse, offsets = distinct_words(texts)
    rows, cols = [], []
    for slots, first, count in _parts(folded, starts, ends):
        rows.append(np.repeat(np.arange(len(starts), dtype=np.int32), count))
        run = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        cols.append(slots[np.repeat(first, count) + run].astype(np.int32))
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    order = np.argsort(rows, kind="stable")
    words = _Rows(cols[order], np.searchsorted(rows[order], np.arange(len(starts) + 1)))
    del rows, cols, order, run
    bounds, owner = _passages(offsets)
    passages = _Rows(*_bags(inverse, bounds), PASSAGE_WORDS)
    y = np.array(labels)[owner]

    size = 1 << SLOT_BITS
    embed = rng.normal(0, 0.01, (size, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, 2)), np.zeros(2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (embed, out, bias)]
    tops = [[0.0] for _ in state]
    step = 0
    for round_ in range(ROUNDS):
        # the passage of each text that the model finds most toxic speaks for it
        if round_:
            margin = passages.mean(words.mean(embed)) @ (out[:, 1] - out[:, 0])
            worst = np.lexsort((-margin, owner))
            chosen = worst[np.concatenate(([True], owner[worst][1:] != owner[worst][:-1]))]
        else:
            chosen = np.arange(len(owner))
        gold = np.eye(2)[y[chosen]]
        weight = np.where(y[chosen] == 1, 0.5 / max(1, (y[chosen] == 1).sum()), 0.5 / max(1, (y[chosen] == 0).sum()))
        for _ in range(STEPS):
            step += 1
            doc = passages.mean(words.mean(embed), chosen)
            logits = doc @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - gold) * weight[:, None]
            d_vectors = passages.back(d @ out.T, len(starts), chosen)
            grads = (words.back(d_vectors, size) + DECAY * embed, doc.T @ d + DECAY * out, d.sum(axis=0))
            for x, g, (m, v), top in zip((embed, out, bias), grads, state, tops):
                top[0] = max(top[0], float(np.abs(g).max()))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                # the floor keeps slots whose gradients are small, as noisy labels make them, from moving far
                x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + FLOOR * top[0])
    return {"slots": (embed @ (out[:, 1] - out[:, 0])).astype(np.float32), "bias": float(bias[1] - bias[0])}


def score_texts(texts: list[str | None], model: dict | None) -> np.ndarray:
    """Score of each text: that of its most toxic passage; the bias alone speaks for a text without words."""
    if model is None:
        return np.zeros(len(texts))
    folded, starts, ends, inverse, offsets = distinct_words(texts)
    logit = np.full(len(texts), -np.inf)
    if len(inverse):
        total, count_all = np.zeros(len(starts)), np.zeros(len(starts))
        for slots, first, count in _parts(folded, starts, ends):
            total += word_sums(model["slots"][slots.astype(np.int64)], first, count)
            count_all += count
        bounds, owner = _passages(offsets)
        words, word_bounds = _bags(inverse, bounds)
        means = np.add.reduceat((total / count_all)[words], word_bounds[:-1]) / PASSAGE_WORDS
        np.maximum.at(logit, owner, means)
    logit = np.where(np.isinf(logit), 0.0, logit) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train_toxicity_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """A model from labelled documents outside the held-out fold, at most ``sample_docs`` per class.

    None unless both classes have a text to learn from.
    """
    marks = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                          & (F.pmod(crc_of_id(), F.lit(FOLDS)) != HELD_OUT))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id")
    chosen = (marks.join(usable, "doc_id", "left_semi").withColumn("n", F.row_number().over(order))
              .where(F.col("n") <= sample_docs).select("doc_id", "toxic"))
    # at most 2 * sample_docs ids
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    if len({r["toxic"] for r in rows}) < 2:
        return None
    return fit_toxicity([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with ``score`` and ``predicted`` (1 from THRESHOLD on).

    Only ``text`` is looked at; a null or empty text has the score of the bias alone, and every
    text scores 0 when there is no model.  Rows are independent: repeated rows repeat their
    result, an empty table gives no rows.  Kept columns named like the results are left out.
    """
    small_arrow_batches(docs.sparkSession)
    kept = [c for c in keep if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = score_texts(batch.column(0).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32())],
                names=[*kept, "score", "predicted"])

    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(F.col("text").alias("__text"), *kept).mapInArrow(run, schema)
