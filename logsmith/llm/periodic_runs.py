"""Periodic run detection by seeds on diagonals.

A run is a stretch of words with smallest period q and at least four periods.  On the diagonal
of lag q its words match their successors over at least 3q places, so with lags in classes
[2**j, 2**(j + 1)) every run of a class has matching k-grams of k = 3 * 2**j words (5 for lag 1,
as a run has at least 6 words): the k-grams of minimum guaranteed overlap.

* Seeds.  The k-grams of a class are ranked exactly by doubling (a rank of 2**m words from two
  ranks of half as many), within each document.  Only neighbouring occurrences of a k-gram are
  paired: k >= q, so between a k-gram of a run and its copy one period on there is no other
  (two periods that overlap so far would have a common smaller one).  A class has no more pairs
  than the text has words, whatever repeats.
* Extension.  Seeds are taken by lag and place.  A table of the furthest covered place of each
  lag skips seeds inside a stretch already extended; the others grow both ways while words match.

A place whose 2**m-gram does not come again in its document leaves the index, so in plain text
the larger classes are empty at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logsmith.llm.common import small_arrow_batches

#: A run has at least so many words, and so many periods.
WORDS_LEAST, PERIODS_LEAST = 6, 4
#: Texts are taken together up to about so many bytes; one text is never cut.
CHUNK_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words (exact)."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = data[~_SPACE[data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): places of keys sorted stably, and whether each begins a group of equal ones."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    return order, np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])) if len(keys) else np.empty(0, bool)


def _grams(left: np.ndarray, right: np.ndarray, gap: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the grams made of a left rank and the right rank ``gap`` words on."""
    at = np.flatnonzero(left[:-gap] >= 0) if gap < len(left) else np.empty(0, np.int64)
    at = at[(right[at + gap] >= 0) & (docs[at] == docs[at + gap])]
    return at, left[at] * np.int64(len(left) + 1) + right[at + gap]


def _doubled(rank: np.ndarray, half: int, docs: np.ndarray) -> np.ndarray:
    """Ranks of grams twice as long; -1 where there is none or it does not come again."""
    out = np.full(len(rank), -1, dtype=np.int64)
    at, keys = _grams(rank, rank, half, docs)
    if len(at):
        order, first = _repeats(keys)
        again = ~first
        again[:-1] |= ~first[1:]
        out[at[order[again]]] = (np.cumsum(first) - 1)[again]
    return out


def _seeds(left: np.ndarray, right: np.ndarray, gap: int, docs: np.ndarray, lags: tuple[int, int]) -> np.ndarray:
    """(lag, place) of neighbouring occurrences of a k-gram at a lag of the class, sorted."""
    at, keys = _grams(left, right, gap, docs)
    order, first = _repeats(keys)
    places = at[order]
    lag = np.diff(places)
    keep = ~first[1:] & (lag >= lags[0]) & (lag < lags[1])
    found = np.stack([lag[keep], places[:-1][keep]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def _match_end(words: np.ndarray, at: int, lag: int) -> int:
    """First place from ``at`` on whose word differs from the one ``lag`` words on."""
    size = 16
    while at + lag < len(words):
        end = min(at + size, len(words) - lag)
        wrong = np.flatnonzero(words[at:end] != words[at + lag:end + lag])
        if len(wrong):
            return at + int(wrong[0])
        at, size = end, size * 2
    return at


def _match_start(words: np.ndarray, at: int, lag: int) -> int:
    """Least place from which all words up to ``at`` are those ``lag`` words on."""
    size = 16
    while at > 0:
        begin = max(at - size, 0)
        wrong = np.flatnonzero(words[begin:at] != words[begin + lag:at + lag])
        if len(wrong):
            return begin + int(wrong[-1]) + 1
        at, size = begin, size * 2
    return 0


def word_runs(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs; ``words`` numbered apart in each document, ``docs``
    the growing document number of each word.  Sorted by start, then period."""
    found: list[tuple[int, int, int]] = []
    covered: dict[int, int] = {}
    longest = int(np.bincount(docs).max()) if len(docs) else 0
    order, first = _repeats(words)
    base = np.empty(len(words), dtype=np.int64)
    base[order] = np.cumsum(first) - 1
    ranks = [base]  # of 2**m words

    def rank(m: int) -> np.ndarray:
        while len(ranks) <= m:
            ranks.append(_doubled(ranks[-1], 1 << (len(ranks) - 1), docs))
            if len(ranks) > 3:
                ranks[len(ranks) - 4] = None  # only the last ones are needed again
        return ranks[m]

    j = 0
    while PERIODS_LEAST << j <= longest or (j == 0 and longest >= WORDS_LEAST):
        # lag 1: 4 words and one more; else 2 * 2**j words and 2**j more
        right, left = base if j == 0 else rank(j), rank(2 if j == 0 else j + 1)
        if not (left >= 0).any():
            break
        seeds = _seeds(left, right, 4 if j == 0 else 2 << j, docs, (1 << j, 2 << j))
        # of neighbouring places on one diagonal the first speaks for all
        fresh = np.ones(len(seeds), dtype=bool)
        fresh[1:] = (seeds[1:, 0] != seeds[:-1, 0]) | (seeds[1:, 1] != seeds[:-1, 1] + 1)
        for lag, place in seeds[fresh].tolist():
            if place < covered.get(lag, 0):
                continue
            begin, end = _match_start(words, place, lag), _match_end(words, place, lag)
            covered[lag] = end
            if end - begin + lag >= max(WORDS_LEAST, PERIODS_LEAST * lag):
                found.append((begin, end - begin + lag, lag))
        j += 1
    runs = np.array(found, dtype=np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _text_runs(texts: list[bytes]):
    """For each text (number of words, its runs, the text without repeated periods)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([1], space.view(np.int8))))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    first_word = np.searchsorted(starts, begins)
    docs = np.repeat(np.arange(len(texts)), np.diff(first_word))
    numbers = _word_numbers(data, starts, ends)
    runs = word_runs(docs * np.int64(len(numbers) + 1) + numbers, docs)

    dropped = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    # a kept word stays with the white space byte behind it, as a blank
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    inside[starts[kept]] += 1
    np.add.at(inside, ends[kept] + 1, -1)
    stays = np.cumsum(inside[:-1]) > 0
    shown = np.where(space, np.uint8(0x20), data)[stays].tobytes()
    cut = np.concatenate(([0], np.cumsum(stays)))[begins].tolist()
    of_run = np.searchsorted(runs[:, 0], first_word)
    for i in range(len(texts)):
        mine = runs[of_run[i]:of_run[i + 1]]
        yield (int(first_word[i + 1] - first_word[i]), mine - np.array([first_word[i], 0, 0]),
               shown[cut[i]:max(cut[i], cut[i + 1] - 1)])


RUNS_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _chunks(texts: list[bytes]):
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHUNK_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _collapse(batches):
    for batch in batches:
        *others, texts = batch.columns
        raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        counts, ends, flat, shown = [], [0], [], []
        for part in _chunks(raw):
            for n, runs, text in _text_runs(part):
                counts.append(n)
                flat.append(runs)
                ends.append(ends[-1] + len(runs))
                shown.append(text)
        all_runs = np.concatenate(flat) if flat else np.empty((0, 3), np.int64)
        structs = pa.StructArray.from_arrays([pa.array(c) for c in all_runs.T.copy()], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
             pa.array(shown, pa.binary()).cast(pa.string())], names=[*batch.schema.names[:-1], "n_words", "runs", "text"])


def collapse_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per input row the ``keep`` columns, n_words, runs and text.

    runs holds (start, length, period) of every periodic run, by start, then period: word
    numbers from 0, words being runs of other characters than 0x20 and 0x09-0x0D, told apart
    exactly.  text is the text's words without those that any run contains after its first
    period, joined by one blank.  A null text is empty; null, empty and blank texts have no
    words, no runs and the text ''.  Repeated rows and ids give a row each, an empty table no
    rows; other columns are ignored.  One pass over each text, without a shuffle.
    """
    small_arrow_batches(docs.sparkSession)
    read = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(_collapse, f"{kept}, {RUNS_SCHEMA}")
