"""Language ID by a linear-chain conditional random field over words.

Every word of a text gets a language label.  Its emission scores add hashed character
n-grams (2 to 4 bytes, word boundaries included, so they hold short affixes), longer affixes
(first and last four bytes with the boundary) and a lexicon entry (the whole word).
Transitions between the labels of neighbouring words are learned together with these
weights, by the gradient of the conditional likelihood, on sequences stitched from windows
of documents in different languages, so switches occur in training.  Forward-backward over
the whole text gives each word's posterior; a document's language is the one with the
largest mean posterior over its words with letters.

Training takes a bounded sample: SAMPLE_DOCS documents per language (lowest hash of the
id), WINDOWS windows of WINDOW_WORDS words from each.  Scoring covers whole texts: the
recursion runs over all words of a batch in blocks whose transfer matrices are multiplied
first, so that numpy works on all blocks at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsmith.llm.common import crc_of_id, small_arrow_batches
from logsmith.llm.words import _hash_words, distinct_words, ngram_slots, word_pieces, word_sums

UNDETERMINED = "und"
FOLDS, HELD_OUT = 5, 0
SAMPLE_DOCS = 400
WINDOWS, WINDOW_WORDS = 2, 25
SEQUENCE_WINDOWS = 4
SLOT_BITS = 18
NGRAMS = (2, 3, 4)
AFFIX = 5
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.05, 1e-4
BLOCK, SCALE_STEPS = 256, 8

_LETTER = np.zeros(256, dtype=np.float32)
_LETTER[65:91] = _LETTER[97:123] = 1
_LETTER[128:] = 1


def _word_features(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each feature kind: slots, and per word the first slot and their number."""
    padded = np.concatenate(([0x20], folded, [0x20])).astype(np.uint8)  # word w is padded[s + 1:e + 1]
    for n in NGRAMS:
        if len(padded) >= n:
            yield ngram_slots(padded, n, SLOT_BITS), starts, np.maximum(ends - starts + 3 - n, 0)
    if len(padded) >= AFFIX:
        slots = ngram_slots(padded, AFFIX, SLOT_BITS)
        long = ends - starts >= AFFIX - 1
        where = np.flatnonzero(long)
        for at, kind in ((starts, 1), (ends + 2 - AFFIX, 2)):
            yield (slots[at[where]] ^ np.uint64(kind * 0x1357), np.cumsum(long) - long, long.astype(np.int64))
    words = _hash_words(folded, starts, ends) >> np.uint64(64 - SLOT_BITS)
    yield words ^ np.uint64(0x2468), np.arange(len(starts)), np.ones(len(starts), dtype=np.int64)


def _emissions(texts: list[str | None], weights: np.ndarray):
    """(scores per word and label, letters per word, word offsets of the texts)."""
    folded, starts, ends, inverse, offsets = distinct_words([None if t is None else t.lower() for t in texts])
    total = np.zeros((len(starts), weights.shape[1]), dtype=np.float32)
    if not len(starts):
        return total, np.zeros(0, bool), offsets
    for slots, first, count in _word_features(folded, starts, ends):
        if len(slots):
            total += word_sums(weights[slots.astype(np.int64)], first, count)
    letters = word_sums(_LETTER[folded], starts, ends - starts) > 0
    return total[inverse], letters[inverse], offsets


def posteriors(scores: np.ndarray, offsets: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label posteriors of all words by forward-backward; offsets part the sequences."""
    n, k = scores.shape
    if n == 0:
        return scores
    blocks = -(-n // BLOCK)
    phi = np.zeros((blocks * BLOCK, k))
    phi[:n] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    phi[n:] = 1
    phi = phi.reshape(blocks, BLOCK, k)
    first = np.zeros(blocks * BLOCK, dtype=bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    first[n:] = True
    first = first.reshape(blocks, BLOCK)
    a, pi = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    one = np.ones(k)
    # transfer matrix of every block; scaled now and then, as each step shrinks sums by no
    # more than the smallest transition
    whole = np.tile(np.eye(k), (blocks, 1, 1))
    for i in range(BLOCK):
        moved = (whole.reshape(-1, k) @ a).reshape(blocks, k, k)
        begun = np.flatnonzero(first[:, i])
        if len(begun):
            moved[begun] = (whole[begun] @ one)[:, :, None] * pi
        whole = moved
        whole *= phi[:, i, None, :]
        if i % SCALE_STEPS == SCALE_STEPS - 1:
            whole /= whole.reshape(blocks, -1).max(axis=1)[:, None, None]
    into, out_of = np.ones((blocks, k)), np.ones((blocks, k))
    for c in range(1, blocks):
        v = into[c - 1] @ whole[c - 1]
        into[c] = v / (v @ one)
    for c in range(blocks - 2, -1, -1):
        v = whole[c + 1] @ out_of[c + 1]
        out_of[c] = v / (v @ one)
    both = np.empty((BLOCK, blocks, k))
    v = into
    for i in range(BLOCK):
        v = v @ a
        begun = np.flatnonzero(first[:, i])
        if len(begun):
            v[begun] = pi
        v *= phi[:, i]
        if i % SCALE_STEPS == SCALE_STEPS - 1:
            v /= (v @ one)[:, None]
        both[i] = v
    v = out_of
    for i in range(BLOCK - 1, -1, -1):
        both[i] *= v
        v = (phi[:, i] * v) @ a.T
        begun = np.flatnonzero(first[:, i])
        if len(begun):
            v[begun] = 1.0
        if i % SCALE_STEPS == 0:
            v /= (v @ one)[:, None]
    both = both.transpose(1, 0, 2).reshape(-1, k)[:n]
    return both / (both @ one)[:, None]


def _padded_gradient(scores, gold, lengths, transitions, start):
    """Gradients of the negative log likelihood by node scores, transitions and start, for
    padded sequences scores[b, t, k] with gold labels and lengths."""
    b, t, k = scores.shape
    a, pi = np.exp(transitions), np.exp(start)
    phi = np.exp(scores - scores.max(axis=2, keepdims=True))
    inside = np.arange(t)[None, :] < lengths[:, None]
    alpha, beta = np.empty_like(phi), np.ones_like(phi)
    v = pi * phi[:, 0]
    alpha[:, 0] = v / v.sum(axis=1, keepdims=True)
    for i in range(1, t):
        v = (alpha[:, i - 1] @ a) * phi[:, i]
        alpha[:, i] = np.where(inside[:, i, None], v / v.sum(axis=1, keepdims=True), alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        v = (phi[:, i + 1] * beta[:, i + 1]) @ a.T
        beta[:, i] = np.where(inside[:, i + 1, None], v / v.sum(axis=1, keepdims=True), 1.0)
    node = alpha * beta
    node /= node.sum(axis=2, keepdims=True)
    pair = alpha[:, :-1, :, None] * a * (phi * beta)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    pair *= inside[:, 1:, None, None]
    hot = np.eye(k)[gold] * inside[:, :, None]
    d_nodes = node * inside[:, :, None] - hot
    d_pairs = pair.sum(axis=(0, 1)) - np.einsum("btk,btl->kl", hot[:, :-1] * inside[:, 1:, None], hot[:, 1:])
    return d_nodes, d_pairs, (node[:, 0] - hot[:, 0]).sum(axis=0)


class _Adam:
    def __init__(self, shape, rate):
        self.m, self.v, self.n, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, x, g):
        self.n += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        x -= self.rate * (self.m / (1 - 0.9 ** self.n)) / (np.sqrt(self.v / (1 - 0.999 ** self.n)) + 1e-8)


def fit_crf(texts: list[str], labels: list[int], k: int, seed: int = 7) -> dict:
    """Weights of the field from labelled texts; deterministic."""
    rng = np.random.default_rng(seed)
    windows = []
    for text, label in zip(texts, labels):
        words = text.lower().split()
        if words:
            for at in rng.integers(0, max(1, len(words) - WINDOW_WORDS + 1), WINDOWS):
                windows.append((words[at:at + WINDOW_WORDS], label))
    order = rng.permutation(len(windows))
    groups = [[windows[i] for i in order[j:j + SEQUENCE_WINDOWS]] for j in range(0, len(order), SEQUENCE_WINDOWS)]
    sequences = [([w for ws, _ in g for w in ws], [y for ws, y in g for _ in ws]) for g in groups]

    # one row of feature slots per word, through the same code as scoring
    pieces, _ = word_pieces([" ".join(ws) for ws, _ in sequences])
    rows, cols, base = [], [], 0
    for _, folded, starts, ends in pieces:
        for slots, first, count in _word_features(folded, starts, ends):
            rows.append(base + np.repeat(np.arange(len(starts)), count))
            run = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            cols.append(slots[(np.repeat(first, count) + run)].astype(np.int64))
        base += len(starts)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    order = np.argsort(rows, kind="stable")
    cols, pointer = cols[order], np.searchsorted(rows[order], np.arange(base + 1))
    ends_at = np.cumsum([len(ws) for ws, _ in sequences])

    weights, transitions, start = np.zeros((1 << SLOT_BITS, k)), np.zeros((k, k)), np.zeros(k)
    opt = _Adam(weights.shape, RATE), _Adam((k, k), RATE), _Adam(k, RATE)
    for _ in range(EPOCHS):
        for chosen in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // BATCH)):
            lengths = np.array([len(sequences[i][0]) for i in chosen])
            t = lengths.max()
            inside = np.arange(t)[None, :] < lengths[:, None]
            word = np.concatenate([np.arange(ends_at[i] - len(sequences[i][0]), ends_at[i]) for i in chosen])
            gold = np.zeros((len(chosen), t), dtype=np.int64)
            gold[inside] = np.concatenate([sequences[i][1] for i in chosen])
            count = pointer[word + 1] - pointer[word]
            at = np.repeat(pointer[word] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            used = cols[at]
            node = np.zeros((len(chosen), t, k))
            node[inside] = word_sums(weights[used], np.cumsum(count) - count, count)
            d_node, d_pair, d_start = _padded_gradient(node, gold, lengths, transitions, start)
            per_slot = np.repeat(d_node[inside], count, axis=0)
            grad = np.stack([np.bincount(used, per_slot[:, j], minlength=len(weights)) for j in range(k)], axis=1)
            opt[0].step(weights, grad / len(chosen) + DECAY * weights)
            opt[1].step(transitions, d_pair / len(chosen) + DECAY * transitions)
            opt[2].step(start, d_start / len(chosen) + DECAY * start)
    return {"weights": weights.astype(np.float32), "transitions": transitions, "start": start}


def train_language_model(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """A model from the documents outside the held-out fold that have a text and a lang.

    ``sample_docs`` bounds the documents per language.  None if there is nothing to learn from.
    """
    marked = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")
                        & (F.pmod(crc_of_id(), F.lit(FOLDS)) != HELD_OUT))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "lang"), "doc_id")
    chosen = (marked.select("doc_id", "lang").withColumn("n", F.row_number().over(order))
              .where(F.col("n") <= sample_docs).select("doc_id", "lang").distinct())
    # the chosen ids are at most sample_docs a language
    rows = (marked.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy("lang", "doc_id").collect())
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    place = {x: i for i, x in enumerate(languages)}
    return {"languages": languages} | fit_crf([r["text"] for r in rows], [place[r["lang"]] for r in rows],
                                              len(languages))


def label_texts(texts: list[str | None], model: dict | None) -> tuple[list[str], np.ndarray]:
    """Predicted language and score (its mean word posterior) of each text."""
    if model is None or not texts:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    scores, letters, offsets = _emissions(texts, model["weights"])
    words = posteriors(scores, offsets, model["transitions"], model["start"]) * letters[:, None]
    sums = word_sums(words, offsets[:-1], np.diff(offsets))
    count = np.maximum(word_sums(letters.astype(np.int64), offsets[:-1], np.diff(offsets)), 1)
    means = sums / count[:, None]
    best = means.argmax(axis=1)
    labels, score = [], np.clip(means[np.arange(len(texts)), best], 0.0, 1.0)
    for i, text in enumerate(texts):
        if text is None or not any(map(str.isalpha, text)):
            labels.append(UNDETERMINED)
            score[i] = 0.0
        else:
            labels.append(model["languages"][best[i]])
    return labels, score


def predict_languages(docs: DataFrame, model: dict | None, keep: list[str],
                      names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``keep`` columns of every row, with the predicted language and its score.

    Only ``text`` is looked at.  A null text, or one without a letter, is ``und`` with score
    0; so is every text when there is no model.  Rows are independent: repeated rows repeat
    their result, an empty table gives no rows.  A kept column named like a result column is
    left out.
    """
    small_arrow_batches(docs.sparkSession)
    kept = [c for c in keep if c not in names]
    fields = docs.select(*kept).schema.fields
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            labels, scores = label_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept, *names])

    schema = T.StructType([*fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.select(F.col("text").alias("__text"), *kept).mapInArrow(score, schema)
