"""Word and shingle hashing over batches of texts, vectorised with numpy.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D in the UTF-8 form of a
text, with A-Z lower-cased.  All functions work on whole texts: a batch is processed as
one byte stream cut only at white space, so memory is bounded by the piece size or by the
longest single word, never by a prefix rule.
"""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array of uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables(dict):
    """A cache that is empty again after it has travelled to a task."""

    def __reduce__(self):
        return _Tables, ()


_tables = _Tables()


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = max(n, PIECE_BYTES + 1)
        _tables["up"], _tables["down"] = _powers(_BASE, size), _powers(_INV, size)
    return _tables["up"][:n], _tables["down"][:n]


def _encoded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte stream with a line feed after each, and where each begins."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    begins = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=begins[1:])
    return np.frombuffer(b"\n".join(raw), dtype=np.uint8), begins


def _cuts(data: np.ndarray):
    """Bounds of pieces of about PIECE_BYTES that end after white space: no word is cut."""
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        if end < len(data):
            space = np.flatnonzero(_SPACE[data[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
            else:  # one very long word: on to the next white space
                while end < len(data):
                    found = np.flatnonzero(_SPACE[data[end:end + PIECE_BYTES]])
                    if len(found):
                        end += int(found[0]) + 1
                        break
                    end = min(end + PIECE_BYTES, len(data))
        yield at, end
        at = end


def word_pieces(texts: list[str | None]):
    """(pieces, begins): a generator of (at, folded bytes, word starts, word ends) over the
    stream of all texts, A-Z lower-cased and white space as 0x20, and where each text begins
    in the stream.  Starts and ends are inside the piece."""
    data, begins = _encoded(texts)

    def pieces():
        for at, end in _cuts(data):
            folded = _FOLD[data[at:end]]
            space = _SPACE[folded]
            folded[space] = 0x20
            edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
            yield at, folded, np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return pieces(), begins


def _hash_words(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(folded) + 1)
    total = np.zeros(len(folded) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[folded] * down[: len(folded)], out=total[1:])
    return mix((total[ends] - total[starts]) * up[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of growing, disjoint spans of a byte stream, case kept, a piece at a time."""
    out = np.empty(len(starts), np.uint64)
    group = starts // PIECE_BYTES
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(starts)])) if len(starts) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        base, end = int(starts[a]), int(ends[b - 1])
        up, down = _power_tables(end - base + 1)
        total = np.zeros(end - base + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data[base:end]] * down[:end - base], out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = mix((total[e] - total[s]) * up[s] + (e - s).astype(np.uint64))
    return out


def word_hashes(texts: list[str | None], spans: bool = False):
    """Hashes of all words of all texts, and where each text's words begin.

    Returns (hashes, offsets) with text i's words at hashes[offsets[i]:offsets[i + 1]];
    with ``spans`` also the byte start and end of each word inside its own text.
    A null text has no words.
    """
    pieces, begins = word_pieces(texts)
    empty = np.empty(0, np.int64)
    parts = [(empty, empty, np.empty(0, np.uint64))]
    parts += [(s + at, e + at, _hash_words(folded, s, e)) for at, folded, s, e in pieces]
    starts, ends, hashes = (np.concatenate(p) for p in zip(*parts))
    offsets = np.searchsorted(starts, begins)
    if not spans:
        return hashes, offsets
    base = np.repeat(begins[:-1], np.diff(offsets))
    return hashes, offsets, starts - base, ends - base


def distinct_words(texts: list[str | None]):
    """(folded, starts, ends, inverse, offsets): a padded stream of the batch's distinct words,
    where each lies in it, and for every word of every text the number of its distinct word."""
    pieces, begins = word_pieces(texts)
    streams, hashes, starts, ends, base = [], [], [], [], 0
    for at, folded, s, e in pieces:
        streams.append(folded)
        hashes.append(_hash_words(folded, s, e))
        starts.append(s + at)
        ends.append(e + at)
    if not hashes:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint8), none, none, none, np.zeros(len(begins), np.int64)
    stream, starts, ends = np.concatenate(streams), np.concatenate(starts), np.concatenate(ends)
    _, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    size = ends[first] - starts[first]
    new_ends = np.cumsum(size + 1)
    new_starts = new_ends - size  # one blank before each word
    out = np.full(int(new_ends[-1]) + 1 if len(size) else 1, 0x20, dtype=np.uint8)
    run = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(new_starts, size) + run] = stream[np.repeat(starts[first], size) + run]
    return out, new_starts, new_ends, inverse, np.searchsorted(starts, begins)


def _words_as_written(texts: list[str | None]):
    data, begins = _encoded(texts)
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return data, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, begins)


def words_as_written(texts: list[str | None]):
    """(hashes, offsets): hashes of all words of all texts, case kept, as in distinct_words_as_text."""
    return _words_as_written(texts)[3:]


def distinct_words_as_text(texts: list[str | None]):
    """(words, hashes, inverse, offsets): distinct words of a batch as strings, case kept."""
    data, starts, ends, each, offsets = _words_as_written(texts)
    hashes, first, inverse = np.unique(each, return_index=True, return_inverse=True)
    return _texts(data, starts[first], ends[first]), hashes, inverse, offsets


def new_words_as_text(texts: list[str | None], known: np.ndarray):
    """(words, hashes): distinct words that are not among the sorted ``known`` hashes."""
    data, starts, ends, each, _ = _words_as_written(texts)
    new = np.flatnonzero(~among(known, each))
    hashes, first = np.unique(each[new], return_index=True)
    return _texts(data, starts[new[first]], ends[new[first]]), hashes


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    stream = data.tobytes()
    return [stream[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts.tolist(), ends.tolist())]


def among(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is one of the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def words_and_lines(texts: list[str | None]):
    """(hashes, offsets, lines): as word_hashes, with the number of each word's line; lines of
    different texts differ."""
    data, _ = _encoded(texts)
    hashes, offsets, starts, _ends = word_hashes(texts, spans=True)
    raw = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([0 if t is None else len(t.encode("utf-8", "surrogatepass")) for t in texts], out=raw[1:])
    begins = raw[:-1] + np.arange(len(texts))
    feeds = np.flatnonzero(data == 0x0A)
    return hashes, offsets, np.searchsorted(feeds, starts + np.repeat(begins, np.diff(offsets)))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:-rest], out[rest:]) if rest else out


def ngram_slots(folded: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash slot of the n bytes (n <= 8) that begin at each place of a padded piece."""
    value = np.zeros(len(folded) - n + 1, dtype=np.uint64)
    for i in range(n):
        value = (value << np.uint64(8)) | folded[i:len(folded) - n + 1 + i]
    return ((value + np.uint64(n)) * np.uint64(_BASE)) >> np.uint64(64 - bits)


def word_sums(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of values[first:first + count] for growing, disjoint runs; an empty run sums to 0."""
    some = count > 0
    out = np.zeros((len(first), *values.shape[1:]), dtype=values.dtype)
    if some.any():
        bounds = np.stack([first[some], first[some] + count[some]], axis=1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        out[some] = np.add.reduceat(padded, bounds, axis=0)[::2]
    return out


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one word sequence; a shorter, non-empty one is a single window."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    out = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        out = out * _STEP + words[i:n - width + 1 + i]
    return mix(out + np.uint64(width))


def all_shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in one array, and where each text's begin."""
    lengths = np.diff(offsets)
    counts = np.where(lengths >= k, lengths - k + 1, (lengths > 0).astype(np.int64))
    begins = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(counts, out=begins[1:])
    out = np.empty(begins[-1], dtype=np.uint64)
    if len(words) >= k:
        full = shingle_hashes(words, k)  # also across texts; those windows are not picked
        long = np.flatnonzero(lengths >= k)
        picked = np.arange(counts[long].sum()) + np.repeat(
            offsets[long] - np.concatenate(([0], np.cumsum(counts[long])[:-1])), counts[long])
        to = np.arange(counts[long].sum()) + np.repeat(
            begins[long] - np.concatenate(([0], np.cumsum(counts[long])[:-1])), counts[long])
        out[to] = full[picked]
    for i in np.flatnonzero((lengths > 0) & (lengths < k)):
        out[begins[i]] = shingle_hashes(words[offsets[i]:offsets[i + 1]], k)[0]
    return out, begins


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorts in place."""
    values.sort()
    if len(values) < 2:
        return values
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text."""
    hashes, begins = all_shingles(*word_hashes(texts), k)
    return [distinct(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:])]
