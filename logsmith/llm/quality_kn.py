"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

Two models are trained on trusted text, all documents labelled of good quality.  The word model
predicts each word from the word before it (at the beginning of a text, from a mark); what its
discounts set aside goes to the words' continuation counts, and from there to the character
model, which so gives unknown words their probability.  The character model reads inside words: a word is the symbols
^ c1 .. cn $, and each symbol after ^ is predicted from up to ORDER - 1 before it.

* Counts: tasks add up the n-grams of their own texts; the sums are sharded by n-gram.  Lower
  orders use continuation counts, except for n-grams that begin with ^.
* Discounts: three per order, from the counts of counts.  A context's share for the lower order
  follows from how many of its n-grams have the counts 1, 2 and more, so tables hold whole numbers only.
* Scoring: documents fall into blocks of about BLOCK_CHARS characters, neighbours in a file
  together.  A block asks each shard of the key space for its distinct words and pairs of
  words, once each, as sorted 64-bit hashes; the shard answers with numbers alone, in the same
  order.  Words are spelled out to their shard, which has the n-gram counts and gives each word's
  probability under the character model once for all blocks.  Each document's log probabilities
  are then summed in its block.  No document's n-grams or words travel one by one.
* Pairs of words are not stored.  To ask for a pair, a block sends along how often its trusted
  documents have it, and the shard's answer is the sum; a bitmap of the trusted pairs keeps others
  out of the question.  In the block a trusted document's own
  pairs are taken out of the counts before it is scored: a model that has read a document knows
  its pairs by heart, and the thresholds would reject text that is as good but was not read.
* Thresholds: a document is kept up to the QUANTILE of the perplexities of trusted documents
  of its language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsmith.llm.common import small_arrow_batches, text_chars
from logsmith.llm.common import stored as write_scratch
from logsmith.llm.sketches import FILTER_BITS_LEAST, may_repeat
from logsmith.llm.words import among, distinct, distinct_words_as_text, mix, new_words_as_text, words_as_written
from logsmith.scratch import drop_scratch, scratch_mark

ORDER = 5
BEGIN, END = "\x02", "\x03"
QUANTILE = 0.995
BLOCK_CHARS = 28_000_000
#: Rows of a file that always stay together in a block, as far as it is not too large.
UNIT_ROWS = 64
#: Labelled ids sent to all tasks at most, so that texts need not be shuffled for the flag.
BROADCAST_IDS = 2_000_000
FLUSH_WORDS = 300_000
FLUSH_PAIRS = 2_500_000
FLUSH_CHARS = 2_000_000
#: Slots of the bitmap of trusted pairs, 8 MB as bits.  Far beyond that many pairs it lets most of the
#: others pass too, which costs shuffle and changes no result.
PAIR_BITS_MOST = 26
#: Symbols of words whose n-grams are worked on at once.
PART_SYMBOLS = 500_000
#: Of the texts, the most that is shuffled.
PAYLOAD_LEVEL = 6
#: Stands for the word before the first one of a text.
START = np.uint64(0)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.multiply.accumulate(np.array([1] + [_STEP] * (ORDER - 1), np.uint64))
#: Kinds of keys.  Numbers in their stores: c, total, ones, twos, more of an n-gram and the context it
#: is; total, ones, twos, more, follows of a word; c of a pair.  A word's answer has two more.
GRAMS, WORDS, PAIRS = 0, 1, 2
_WIDTH = {GRAMS: 5, WORDS: 5, PAIRS: 1}
_ROW = "shard int, block long, kind int, n int, data binary, texts binary"
#: Characters of text for each shard of the words.
SHARD_CHARS = 56_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """A scratch table; the shuffle files of the job that writes it go with the job, not some time later."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return write_scratch(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def word_grams(word: str) -> list[str]:
    """The n-gram of each symbol of a word after ^: itself and up to ORDER - 1 symbols before it."""
    s = BEGIN + word + END
    return [s[max(0, j - ORDER + 1):j + 1] for j in range(1, len(s))]


def _packed(*columns: np.ndarray) -> bytes:
    """64-bit columns compressed, the first (best sorted) as gaps; byte by byte, as the high ones are mostly zero."""
    columns = (np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:])
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes() for x in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    """``width`` columns of ``n`` numbers, as uint64; the first is summed up again."""
    raw = np.frombuffer(pa.decompress(data, 8 * n * width, codec="zstd", asbytes=True), np.uint8)
    out = raw.reshape(width, 8, n).transpose(0, 2, 1).copy().view(np.uint64).reshape(width, n)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _all_unpacked(rows, width: int) -> np.ndarray:
    """The columns of all (n, data)."""
    return np.concatenate([np.empty((width, 0), np.uint64), *(_unpacked(d, n, width) for n, d in rows)], axis=1)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[starts], *(np.add.reduceat(v[order], starts) for v in values))


def _sharded(bits: int, keys: np.ndarray, *values: np.ndarray):
    """(shard, n, data) of sorted keys, by their top bits."""
    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    for shard in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[shard], cuts[shard + 1]
        yield int(shard), int(b - a), _packed(keys[a:b], *(v[a:b] for v in values))


def _shard_bits(chars: int, each: int = BLOCK_CHARS // 2) -> int:
    """So many shards, as a power of two, that each gets the keys of at most ``each`` characters of text."""
    return min(max((int(chars) // each).bit_length(), 1), 16)


def _batch(columns: dict, types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), types)], names=list(columns))


def _key_rows(rows) -> pa.RecordBatch:
    """A batch of _ROW, texts left out."""
    rows = [(*row, None)[:6] for row in rows]
    columns = zip(*rows) if rows else [()] * 6
    return _batch(dict(zip(("shard", "block", "kind", "n", "data", "texts"), columns)),
                  (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))


def _symbols(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts in one, a hash of each symbol in it, and the texts' bounds."""
    text = "".join(texts)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.dtype("<u4"))
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=bounds[1:])
    return text, mix(codes.astype(np.uint64) + np.uint64(1)), bounds


def gram_keys(grams: list[str]) -> np.ndarray:
    """Hashes of texts of at most ORDER symbols."""
    _, x, bounds = _symbols(grams)
    size = np.diff(bounds)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * _POWERS[np.repeat(bounds[1:], size) - 1 - np.arange(len(x))], out=total[1:])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + size.astype(np.uint64))


class WordGrams:
    """The n-grams of some words: ``top`` is the key of that of each symbol after ^, word by word,
    ``first`` where each word's begin, ``at`` where the symbol is and ``order`` how many it has."""

    def __init__(self, words: list[str]):
        self.text, x, bounds = _symbols([BEGIN + w + END for w in words])
        place = np.arange(len(x)) - np.repeat(bounds[:-1], np.diff(bounds))
        # sums[k] at a symbol: of the k symbols up to it
        self._sums = [np.zeros(len(x), np.uint64)]
        for k in range(ORDER):
            self._sums.append(self._sums[-1].copy())
            self._sums[-1][k:] += x[:len(x) - k] * _POWERS[k]
        self.at = np.flatnonzero(place >= 1)
        self.order = np.minimum(place + 1, ORDER)[self.at]
        self.top = self._key(self.at, ORDER)
        for k in range(2, ORDER):
            some = self.order == k
            self.top[some] = self._key(self.at[some], k)
        self.first = bounds[:-1] - np.arange(len(words))

    def _key(self, at: np.ndarray, k: int) -> np.ndarray:
        return mix(self._sums[k][at] + np.uint64(k))

    def keys(self, some: np.ndarray) -> np.ndarray:
        """A row for each of ``some`` of the n-grams: its own key, its order, the keys of its last 1 .. ORDER
        symbols, and those of the 0 .. ORDER - 1 before the last; 0 where it is shorter."""
        at, order = self.at[some], self.order[some]
        out = np.zeros((len(some), 2 + 2 * ORDER), np.uint64)
        out[:, 0], out[:, 1] = self.top[some], order
        for k in range(1, ORDER + 1):
            long = order >= k
            out[long, 1 + k] = self._key(at[long], k)
            out[long, 1 + ORDER + k] = self._key(at[long] - 1, k - 1)
        return out

    def texts(self, some: np.ndarray) -> list[str]:
        return [self.text[j - k + 1:j + 1] for j, k in zip(self.at[some].tolist(), self.order[some].tolist())]


def _parts(words: list[str]):
    """Bounds of runs of words of about PART_SYMBOLS symbols."""
    upto = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2) // PART_SYMBOLS
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(words)] if words else [0]
    yield from zip(cuts[:-1], cuts[1:])


def _count_grams(batches):
    held: dict[str, int] = {}  # words; their n-grams are counted once per flush

    def rows():
        words, n = list(held), np.fromiter(held.values(), np.int64, len(held))
        for a, b in _parts(words):
            grams = WordGrams(words[a:b])
            each = np.repeat(n[a:b], np.diff(np.append(grams.first, len(grams.top))))
            _, some, which = np.unique(grams.top, return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(grams.texts(some), pa.string()),
                                              "n": pa.array(np.bincount(which, each).astype(np.int64))})
    for texts, in _gathered(batches, 0):
        words, _, inverse, _ = distinct_words_as_text(texts)
        for word, n in zip(words, np.bincount(inverse, minlength=len(words)).tolist()):
            held[word] = held.get(word, 0) + n
        if len(held) > FLUSH_WORDS:
            yield from rows()
            held.clear()
    yield from rows()


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the counts of counts."""
    n = [0, n1, n2, n3, n4]
    if not n[1] or not n[2]:
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    # each lies between 0 and its count; small tables can put the estimate outside
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i * y, 0.05), i - 0.05) for i in (1, 2, 3)]


def train_ngram_model(texts: DataFrame) -> dict:
    """Sharded tables of the model, per order (gram, c), and (context, total, ones, twos, more): the sum
    of its n-grams' counts and how many have the count 1, 2 and 3 or more; the discounts; and the base
    probability of a symbol.  ``texts`` has a column text.  Counts cover all of it."""
    spark, mark = texts.sparkSession, scratch_mark()
    small_arrow_batches(spark)
    raw = stored(texts.where("text IS NOT NULL").select("text").mapInArrow(_count_grams, "gram string, n long")
                 .groupBy("gram").agg(F.sum("n").alias("c")), "kn-raw")
    symbols, c = F.char_length("gram"), F.col("c")
    counts, backoffs, cuts = {}, {}, {}
    for k in range(ORDER, 0, -1):
        rows = raw.where(symbols == k)
        if k < ORDER:
            rows = rows.union(counts[k + 1].groupBy(F.substring("gram", 2, ORDER).alias("gram")).agg(F.count(F.lit(1)).alias("c")))
        counts[k] = stored(rows, f"kn-p-{k}")
        n = counts[k].agg(*[F.count_if(c == i) for i in (1, 2, 3, 4)], F.count(F.lit(1))).first()
        cuts[k] = _discounts(*n[:4])
        backoffs[k] = stored(counts[k].groupBy(F.substring("gram", 1, k - 1).alias("context")).agg(
            F.sum("c").alias("total"), F.count_if(c == 1).alias("ones"), F.count_if(c == 2).alias("twos"),
            F.count_if(c > 2).alias("more")), f"kn-backoff-{k}")
    drop_scratch(spark, *counts.values(), *backoffs.values(), since=mark)
    return {"p": counts, "backoff": backoffs, "cuts": cuts, "base": 1.0 / (n[4] + 1)}


def word_pairs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the word before, the key of both) for each word of each text, words as hashes."""
    before = np.concatenate(([START], words[:-1])) if len(words) else words
    before[offsets[:-1][np.diff(offsets) > 0]] = START
    return before, _pair_key(before, words)


def _pair_key(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * _STEP + words)


def _count_pairs(bits: int):
    """mapInArrow function: text -> (shard, n, data), data with (the word before, the word, count) of the task's pairs."""
    def run(batches):
        held, size = [], 0

        def rows():
            before, words = (np.concatenate(x) for x in zip(*held))
            keys = _pair_key(before, words)
            order = np.argsort(keys)
            starts = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
            first, n = order[starts], np.diff(np.append(starts, len(order)))
            shard = keys[first] >> np.uint64(64 - bits)
            cuts = np.searchsorted(shard, np.arange((1 << bits) + 1, dtype=np.uint64))
            out = {"shard": [], "n": [], "data": []}
            for s in np.flatnonzero(np.diff(cuts)):
                at = first[cuts[s]:cuts[s + 1]]
                by = np.argsort(before[at])
                for name, value in zip(out, (int(s), len(at), _packed(before[at][by], words[at][by], n[cuts[s]:cuts[s + 1]][by]))):
                    out[name].append(value)
            return _batch(out, (pa.int32(), pa.int32(), pa.binary()))
        for batch in batches:
            words, offsets = words_as_written(batch.column(0).to_pylist())
            if len(words):
                held.append((word_pairs(words, offsets)[0], words))
                size += len(words)
            if size > FLUSH_PAIRS:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()
    return run


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(c == i)) for i in (1, 2, 3, 4)]


_PAIR_ROW = "words boolean, shard int, n int, data binary, n1 long, n2 long, n3 long, n4 long"
_WORD_ROW = "shard int, n int, data binary, follows long, n1 long, n2 long, n3 long, n4 long, more long"
_INT, _LONG = pa.int32(), pa.int64()


def _merge_pairs(bits: int, slot_bits: int):
    """applyInArrow function for a shard of pairs: a row with the bitmap of its keys and the counts of
    counts, and rows with what its pairs add to each of their words, by shard of the words."""
    def run(table: pa.Table) -> pa.Table:
        before, words, n = _all_unpacked(zip(table.column("n").to_pylist(), table.column("data").to_pylist()), 3)
        keys = _pair_key(before, words)
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        c = np.add.reduceat(n[order], starts)
        held = np.zeros(1 << (slot_bits - bits), bool)
        held[(keys[starts] >> np.uint64(64 - slot_bits)) & np.uint64(len(held) - 1)] = True
        data = pa.compress(np.packbits(held).tobytes(), codec="zstd", asbytes=True)
        out = [(False, table.column("shard")[0].as_py(), len(held) // 8, data, *_counts_of_counts(c))]
        one, none = np.ones(len(c), np.uint64), np.zeros(len(c), np.uint64)
        both = (c, none), (c == 1, none), (c == 2, none), (c > 2, none), (none, one)
        first = order[starts]
        sums = _summed(np.concatenate([before[first], words[first]]), *(np.concatenate(x).astype(np.uint64) for x in both))
        out += [(True, *row, 0, 0, 0, 0) for row in _sharded(bits, *sums)]
        return pa.Table.from_batches([_batch(dict(zip(("words", "shard", "n", "data", "n1", "n2", "n3", "n4"), zip(*out))),
                                             (pa.bool_(), _INT, _INT, pa.binary(), *[_LONG] * 4))])
    return run


def _merge_words(table: pa.Table) -> pa.Table:
    """applyInArrow function for a shard of words: the sums, and the counts of counts of ``follows``."""
    both = _all_unpacked(zip(table.column("n").to_pylist(), table.column("data").to_pylist()), 1 + _WIDTH[WORDS])
    keys, *sums = _summed(*both)
    row = (table.column("shard")[0].as_py(), len(keys), _packed(keys, *sums), int(sums[4].sum()),
           *_counts_of_counts(sums[4]), int(np.count_nonzero(sums[4] > 2)))
    return pa.table([pa.array([v], t) for v, t in zip(row, (_INT, _INT, pa.binary(), *[_LONG] * 6))],
                    names=[x.split()[0] for x in _WORD_ROW.split(", ")])


def train_word_model(texts: DataFrame) -> dict:
    """The sharded counts of words, the discounts, and a bitmap of the pairs.  ``texts`` has a column text.

    ``counts`` has rows of packed words: how often each is followed, by how many different words once, twice
    and more often, and after how many different words it stands.
    """
    spark, mark = texts.sparkSession, scratch_mark()
    small_arrow_batches(spark)
    chars = text_chars(texts)
    bits = _shard_bits(chars)
    # about 16 slots for each word of 6 characters
    slot_bits = min(max((chars // 6).bit_length() + 4, FILTER_BITS_LEAST), PAIR_BITS_MOST)
    pairs = stored(texts.where("text IS NOT NULL").select("text").mapInArrow(_count_pairs(bits), "shard int, n int, data binary")
                   .groupBy("shard").applyInArrow(_merge_pairs(bits, slot_bits), _PAIR_ROW), "kn-pairs")
    known = np.zeros((1 << slot_bits) // 8, np.uint8)
    n = np.zeros(4, np.int64)
    for r in pairs.where("NOT words").collect():
        at = r["shard"] * r["n"]
        known[at:at + r["n"]] = np.frombuffer(pa.decompress(bytes(r["data"]), r["n"], codec="zstd", asbytes=True), np.uint8)
        n += [r["n1"], r["n2"], r["n3"], r["n4"]]
    counts = stored(pairs.where("words").select("shard", "n", "data").groupBy("shard").applyInArrow(_merge_words, _WORD_ROW), "kn-word-counts")
    sums = [x or 0 for x in counts.agg(*[F.sum(x) for x in ("follows", "n1", "n2", "n3", "n4", "more")]).first()]
    of_words = _discounts(*sums[1:5])
    drop_scratch(spark, counts, since=mark)
    return {"counts": counts, "of_pairs": _discounts(*n.tolist()), "of_words": of_words, "known": known, "n": sums[0],
            "taken": sums[1] * of_words[0] + sums[2] * of_words[1] + sums[5] * of_words[2]}


def _gram_store(bits: int):
    """mapInArrow function: (text, c, total, ones, twos, more) -> _ROW without a block, all for every shard of the words."""
    def run(batches):
        batches = list(batches)  # a part of the n-grams, which texts soon have in full
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        values = [np.concatenate([np.empty(0, np.uint64), *(b.column(i).to_numpy(zero_copy_only=False).astype(np.uint64) for b in batches)])
                  for i in range(1, 6)]
        keys, *sums = _summed(gram_keys(texts), *values)
        if len(keys):
            data = _packed(keys, *sums)
            for shard in range(1 << bits):
                yield _key_rows([(shard, None, GRAMS, len(keys), data)])
    return run


def _word_store(bits: int):
    """mapInArrow function: (n, data) of word counts -> _ROW without a block."""
    def run(batches):
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _key_rows([(s, None, WORDS, m, d) for s, m, d in _sharded(bits, *_unpacked(data, n, 1 + _WIDTH[WORDS]))])
    return run


def _found(store: tuple, keys: np.ndarray) -> list[np.ndarray]:
    """The numbers of the keys in a store (sorted keys, numbers), 0 for those it lacks."""
    if not len(store[0]):
        return [np.zeros(len(keys), np.uint64) for _ in store[1:]]
    at = np.minimum(np.searchsorted(store[0], keys), len(store[0]) - 1)
    found = store[0][at] == keys
    return [np.where(found, v[at], np.uint64(0)) for v in store[1:]]


def words_logp(words: list[str], store: tuple, model: dict) -> np.ndarray:
    """Log probability of each word under the character model; it has one symbol more than characters."""
    known, rows, parts = np.empty(0, np.uint64), [np.empty((0, 2 + 2 * ORDER), np.uint64)], []
    for a, b in _parts(words):
        grams = WordGrams(words[a:b])
        new = np.flatnonzero(~among(known, grams.top))
        top, first = np.unique(grams.top[new], return_index=True)
        rows.append(grams.keys(new[first]))
        known = np.sort(np.append(known, top))
        parts.append((grams.top, grams.first))
    table = np.concatenate(rows)
    table = table[np.argsort(table[:, 0])]
    p = np.full(len(table), model["base"])
    for k in range(1, ORDER + 1):
        some = np.flatnonzero(table[:, 1] >= k)
        cuts, c = model["cuts"][k], _found(store, table[some, 1 + k])[0].astype(float)
        _, total, *counts = (x.astype(float) for x in _found(store, table[some, 1 + ORDER + k]))
        seen = total > 0
        some, c, total = some[seen], c[seen], total[seen]
        taken = sum(n[seen] * d for n, d in zip(counts, cuts))
        p[some] = (c - _cut(c, cuts)) / total + taken / total * p[some]
    p = np.log(p)
    return np.concatenate([np.empty(0), *(np.add.reduceat(p[np.searchsorted(known, top)], first) for top, first in parts)])


def _gathered(batches, *columns: int):
    """Rows of batches (lists of the columns' values), put together up to FLUSH_CHARS characters; the last column has texts."""
    held, size = [[] for _ in columns], 0
    for batch in batches:
        for rows, i in zip(held, columns):
            rows += batch.column(i).to_pylist()
        size += sum(len(t) for t in held[-1][len(held[-1]) - batch.num_rows:] if t)
        if size > FLUSH_CHARS:
            yield held
            held, size = [[] for _ in columns], 0
    if held[-1]:
        yield held


def _by_block(blocks: list[int]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        out.setdefault(b, []).append(i)
    return out


def _ask_for_words(bits: int):
    """mapInArrow function: (block, text) -> _ROW with the words of each block in this task, and their texts."""
    def run(batches):
        held: dict[int, list] = {}  # for each block: sorted hashes of its words; hashes and words as they came
        size = 0

        def rows():
            for block, (_, hashes, words) in held.items():
                keys, words = np.concatenate([[START], *hashes]), ["", *words]
                order = np.argsort(keys)
                keys, at = keys[order], 0
                for shard, n, data in _sharded(bits, keys):
                    texts = "\n".join([words[i] for i in order[at:at + n].tolist()]).encode("utf-8", "surrogatepass")
                    yield _key_rows([(shard, block, WORDS, n, data, len(texts).to_bytes(8, "little") + pa.compress(texts, codec="zstd", asbytes=True))])
                    at += n
        for blocks, texts in _gathered(batches, 0, 1):
            for block, rows_of in _by_block(blocks).items():
                of_block = held.setdefault(block, [np.empty(0, np.uint64), [], []])
                words, hashes = new_words_as_text([texts[i] for i in rows_of], of_block[0])
                of_block[0] = np.sort(np.append(of_block[0], hashes))
                of_block[1].append(hashes)
                of_block[2] += words
                size += len(words)
            if size > 4 * FLUSH_WORDS:
                yield from rows()
                held, size = {}, 0
        yield from rows()
    return run


def _ask_for_pairs(bits: int, known):
    """mapInArrow function: (block, text, trusted) -> _ROW with the pairs of each block in this task that
    the broadcast bitmap may hold, and how often its trusted texts have each."""
    def run(batches):
        held: dict[int, list] = {}
        size = 0

        def rows():
            for block, parts in held.items():
                keys, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
                yield _key_rows([(s, block, PAIRS, m, d) for s, m, d in _sharded(bits, keys, n)])
        for batch in batches:
            texts, trusted = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64)
            for block, rows_of in _by_block(batch.column(0).to_pylist()).items():
                words, offsets = words_as_written([texts[i] for i in rows_of])
                keys = word_pairs(words, offsets)[1]
                some = np.flatnonzero(may_repeat(known.value, keys))
                held.setdefault(block, []).append(_summed(keys[some], np.repeat(trusted[rows_of], np.diff(offsets))[some]))
                size += len(held[block][-1][0])
            if size > FLUSH_PAIRS:
                yield from rows()
                held, size = {}, 0
        yield from rows()
    return run


def _words_of(texts: bytes) -> list[str]:
    size = int.from_bytes(texts[:8], "little")
    return pa.decompress(texts[8:], size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass").split("\n") if size else [""]


def _distinct_texts(rows: list[tuple[np.ndarray, bytes]]) -> tuple[np.ndarray, list[str]]:
    """Sorted distinct keys of all (keys, their words' texts), and the words."""
    if not rows:
        return np.empty(0, np.uint64), []
    keys, first = np.unique(np.concatenate([k for k, _ in rows]), return_index=True)
    order = np.argsort(first)  # each row is read once, and only for the words that come in it first
    bounds = np.cumsum([0, *(len(k) for k, _ in rows)])
    cuts = np.searchsorted(first[order], bounds)
    words = [""] * len(keys)
    for (_, texts), begin, a, b in zip(rows, bounds, cuts[:-1], cuts[1:]):
        if a < b:
            these = _words_of(texts)
            for i, j in zip(order[a:b].tolist(), (first[order[a:b]] - begin).tolist()):
                words[i] = these[j]
    return keys, words


def _answers(model: dict | None = None):
    """applyInArrow function for a shard: for each block, the numbers of its distinct keys in their order.
    ``model`` has the discounts of the character model; without it, the keys are pairs."""
    def run(table: pa.Table) -> pa.Table:
        asked: dict[int, list] = {}
        stores: dict[int, list] = {GRAMS: [], WORDS: []}
        texts = []
        for block, kind, n, data, text in zip(*(table.column(x).to_pylist() for x in ("block", "kind", "n", "data", "texts"))):
            if block is None:
                stores[kind].append((n, data))
            else:
                asked.setdefault(block, []).append(_unpacked(data, n, 1 if model else 2))
                texts.append((asked[block][-1][0], text))
        own = {block: _summed(*np.concatenate(x, axis=1)) for block, x in asked.items()}
        if model:
            known, words = _distinct_texts(texts)
            counts = _found(_summed(*_all_unpacked(stores[WORDS], 1 + _WIDTH[WORDS])), known)
            spelled = words_logp(words, _summed(*_all_unpacked(stores[GRAMS], 1 + _WIDTH[GRAMS])), model)
            symbols = np.fromiter(map(len, words), np.uint64, len(words)) + np.uint64(1)
            store, kind = (known, *counts, symbols, spelled.view(np.uint64)), WORDS
        else:  # what the blocks bring is the store
            store, kind = _summed(*(np.concatenate(x) for x in zip(*own.values()))), PAIRS
        shard = table.column("shard")[0].as_py()
        return pa.Table.from_batches([_key_rows([
            (shard, block, kind, len(keys), _packed(np.zeros(len(keys), np.uint64), *_found(store, keys))) for block, (keys, *_) in own.items()])])
    return run


def _payloads(batches):
    """(block, row, text) -> (block, rows, sizes, data): the documents of each block in this task, compressed."""
    held: dict[int, list] = {}
    codec = pa.Codec("zstd", compression_level=PAYLOAD_LEVEL)

    def rows():
        packed = {b: [t.encode("utf-8", "surrogatepass") for _, t in g] for b, g in held.items()}
        row_type = row_types[0]
        return pa.RecordBatch.from_arrays([
            pa.array(packed.keys(), pa.int64()),
            pa.array([[r for r, _ in held[b]] for b in packed], pa.list_(row_type)),
            pa.array([[len(t) for t in g] for g in packed.values()], pa.list_(pa.int64())),
            pa.array([codec.compress(b"".join(g), asbytes=True) for g in packed.values()], pa.binary())],
            names=["block", "rows", "sizes", "data"])
    size, row_types = 0, []
    for batch in batches:
        row_types = row_types or [batch.schema.field(1).type]
        for b, r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            held.setdefault(b, []).append((r, t))
            size += len(t)
        if size > FLUSH_CHARS:
            yield rows()
            held, size = {}, 0
    if held:
        yield rows()


class Answered:
    """The numbers that a block was sent for its distinct keys of a kind."""

    def __init__(self, keys: np.ndarray, answers: list, width: int):
        answers = sorted(answers, key=lambda x: x[0])
        self.keys, self.values = keys, _all_unpacked([x[1:] for x in answers], 1 + width)[1:]
        if self.values.shape[1] != len(keys):
            raise RuntimeError(f"{self.values.shape[1]} answers for {len(keys)} keys")

    def look(self, keys: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        return [v[at].astype(float) for v in self.values[:6]] + [v[at].view(float) for v in self.values[6:]]


def _cut(n: np.ndarray, discounts: list[float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.clip(n, 0, 3).astype(np.int64)]


def _group_sums(group: np.ndarray, key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its (group, key), and the sum of ``values`` (columns) for each number."""
    both = mix(key + mix(group.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both)
    both = both[order]
    new = np.concatenate(([True], both[1:] != both[:-1]))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, np.add.reduceat(values[order], np.flatnonzero(new), axis=0)


def word_model_logp(words: np.ndarray, inverse: np.ndarray, offsets: np.ndarray, trusted: np.ndarray,
                    model: dict, of_words: Answered, of_pairs: Answered) -> np.ndarray:
    """Log probability of each word of all texts; ``words`` are the hashes of distinct words.

    The pairs of a trusted text are taken out of the counts for that text.
    """
    if not len(inverse):
        return np.empty(0)

    def by_word(at: np.ndarray) -> tuple:
        total, ones, twos, more, follows, _, spelled = of_words.look(at)
        return total, sum(n * d for n, d in zip((ones, twos, more), model["of_pairs"])), follows, spelled

    def single(follows, spelled, all_pairs, all_taken):
        known = np.log(follows - _cut(follows, model["of_words"])) - np.log(all_pairs)
        return np.where(all_pairs > 0, np.logaddexp(known, np.log(all_taken) - np.log(all_pairs) + spelled), spelled)

    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    each = words[inverse]
    before, keys = word_pairs(each, offsets)
    c = np.zeros(len(keys))
    if len(of_pairs.keys):
        some = np.flatnonzero(may_repeat(model["known"].value, keys))
        some = some[np.argsort(keys[some])]
        c[some] = of_pairs.look(keys[some])[0]
    # those of the mark before a text come last
    total, taken, follows, spelled = by_word(np.append(words, START))
    previous = np.concatenate(([len(words)], inverse[:-1]))
    previous[offsets[:-1][np.diff(offsets) > 0]] = len(words)
    with np.errstate(divide="ignore", invalid="ignore"):
        rest_of, alone = np.log(taken) - np.log(total), single(follows, spelled, np.float64(model["n"]), np.float64(model["taken"]))
        rest_of, alone = rest_of[previous], alone[inverse]
        total_of = total[previous]
        own = np.flatnonzero(trusted[text])
        if len(own):
            # once per different pair of a text: its count there, and what is left without it
            t = text[own]
            pair, n = _group_sums(t, keys[own], np.ones((len(own), 1)))
            one = np.unique(pair, return_index=True)[1]
            full = c[own][one]
            rest = np.maximum(full - n[:, 0], 0)
            gone = ((rest == 0) & (full > 0)).astype(float)
            lost = np.zeros((len(own), 4))  # at one place of each pair, so that sums count it once
            lost[one, 0] = full - rest
            lost[one, 1] = _cut(full, model["of_pairs"]) - _cut(rest, model["of_pairs"])
            context, sums = _group_sums(t, before[own], lost[:, :2])
            total_of[own] -= sums[context, 0]
            left = np.maximum(taken[previous[own]] - sums[context, 1], 0)
            rest_of[own] = np.log(left) - np.log(total_of[own])
            lost[one, 2] = gone
            word, sums = _group_sums(t, each[own], lost[:, 2:3])
            full = follows[inverse[own]]
            less = np.maximum(full - sums[word, 0], 0)
            some = np.unique(word, return_index=True)[1]
            lost[some, 3] = (_cut(full, model["of_words"]) - _cut(less, model["of_words"]))[some]
            pairs_left = model["n"] - np.bincount(t, lost[:, 2])[t]
            taken_left = np.maximum(model["taken"] - np.bincount(t, lost[:, 3])[t], 0)
            alone[own] = single(less, spelled[inverse[own]], pairs_left, taken_left)
            c[own] = rest[pair]
        out = np.where(total_of > 0, rest_of + alone, alone)
        some = np.flatnonzero(c > 0)
        known = np.log(c[some] - _cut(c[some], model["of_pairs"])) - np.log(total_of[some])
        out[some] = np.logaddexp(known, out[some])
    return out


def _scorer(word_model: dict | None):
    """applyInArrow function: the documents of a block, with the answers to its questions.
    ``word_model`` is without its table; without one, words stand alone."""
    def run(payloads: pa.Table, answers: pa.Table) -> pa.Table:
        sent: dict[int, list] = {WORDS: [], PAIRS: []}
        for kind, *answer in zip(*(answers.column(x).to_pylist() for x in ("kind", "shard", "n", "data"))):
            sent[kind].append(answer)
        texts_of, words, keys = [], [np.array([START])], [np.empty(0, np.uint64)]
        for sizes, data in zip(payloads.column("sizes").to_pylist(), payloads.column("data").to_pylist()):
            stream = pa.decompress(data, sum(sizes), codec="zstd", asbytes=True) if sum(sizes) else b""
            ends = np.cumsum(sizes).tolist()
            each, offsets = words_as_written([stream[e - s:e].decode("utf-8", "surrogatepass") for s, e in zip(sizes, ends)])
            own, inverse = np.unique(each, return_inverse=True)
            texts_of.append((own, inverse.astype(np.int32), offsets))
            words.append(own)
            if word_model is not None:
                found = word_pairs(each, offsets)[1]
                keys.append(distinct(found[may_repeat(word_model["known"].value, found)]))
        of_words = Answered(distinct(np.concatenate(words)), sent[WORDS], _WIDTH[WORDS] + 2)
        if word_model is not None:
            of_pairs = Answered(distinct(np.concatenate(keys)), sent[PAIRS], _WIDTH[PAIRS])
        del words, keys, sent
        kept, total, symbols = [], [], []
        for rows, (own, inverse, offsets) in zip(payloads.column("rows").to_pylist(), texts_of):
            *_, size, spelled = of_words.look(own)
            if word_model is None:
                each = spelled[inverse]
            else:
                trusted = np.array([r["trusted"] for r in rows], dtype=bool)
                each = word_model_logp(own, inverse, offsets, trusted, word_model, of_words, of_pairs)
            upto, n_upto = np.concatenate(([0.0], np.cumsum(each))), np.concatenate(([0], np.cumsum(size.astype(np.int64)[inverse])))
            kept += rows
            total += (upto[offsets[1:]] - upto[offsets[:-1]]).tolist()
            symbols += (n_upto[offsets[1:]] - n_upto[offsets[:-1]]).tolist()
        return pa.table({"row": pa.array(kept, payloads.schema.field("rows").type.value_type),
                         "logp": pa.array(total, pa.float64()), "n_symbols": pa.array(symbols, pa.int64())})
    return run


def _in_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with a column block, and about how many characters the blocks have.

    With a column ``at`` (file, unit: a number of every UNIT_ROWS rows of it) a block is units that
    follow each other.  What is still too large is dealt out by a hash.
    """
    at = F.col("at") if "at" in docs.columns else F.lit(None).cast("struct<file: long, unit: long>")
    units = stored(docs.groupBy(at["file"].alias("file"), at["unit"].alias("unit")).agg(
        F.sum(F.char_length("text")).alias("chars"), F.count(F.lit(1)).alias("n")), "kn-units")
    sums = units.agg(F.sum("chars").alias("chars"), F.sum("n").alias("n"), F.countDistinct("file").alias("files")).first()
    chars = sums["chars"] or 0
    blocks = int(chars // BLOCK_CHARS) + 1
    run = max(1, int(BLOCK_CHARS * (sums["n"] or 0) / max(chars, 1)) // UNIT_ROWS)  # units of a block
    # many small files share blocks
    file = lambda c: c if sums["files"] <= 4 * blocks else F.pmod(c, F.lit(2 * blocks))
    place = lambda f, u: F.xxhash64(F.coalesce(file(f), F.lit(0)), F.coalesce(F.floor(u / run), F.lit(0)))
    large = (units.groupBy(place(F.col("file"), F.col("unit")).alias("place")).agg(F.sum("chars").alias("chars"))
             .where(F.col("chars") > 1.5 * BLOCK_CHARS).withColumn("parts", F.ceil(F.col("chars") / BLOCK_CHARS)))
    parts = {r["place"]: r["parts"] for r in large.collect()}
    out = docs.withColumn("block", place(at["file"], at["unit"]))
    if parts:
        known = docs.sparkSession.createDataFrame(list(parts.items()), "block long, parts long")
        out = out.join(F.broadcast(known), "block", "left").withColumn(
            "block", F.when(F.col("parts").isNotNull(), F.xxhash64("block", F.pmod(F.xxhash64("doc_id", "text"), F.col("parts"))))
            .otherwise(F.col("block"))).drop("parts")
    return out, chars


def document_perplexities(docs: DataFrame, model: dict, keep: list[str], words: dict | None = None) -> DataFrame:
    """The ``keep`` columns (not text) of every row, with n_symbols and perplexity.

    With a word model ``words`` its probabilities count, and ``keep`` has a column trusted: whether
    the model has read the row; the rows with it are all that the model has read.  Without one, those of
    the character model alone.  A text without words has 0 symbols and a null perplexity.
    """
    spark, mark = docs.sparkSession, scratch_mark()
    small_arrow_batches(spark)
    placed, chars = _in_blocks(docs)
    word_bits, bits = _shard_bits(chars, SHARD_CHARS), _shard_bits(chars)
    placed = placed.select("block", F.struct(*keep).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = [t.selectExpr("gram", "c", "0L AS total", "0L AS ones", "0L AS twos", "0L AS more") for t in model["p"].values()]
    rows += [t.selectExpr("context", "0L AS c", "total", "ones", "twos", "more") for t in model["backoff"].values()]
    store = rows[0]
    for table in rows[1:]:
        store = store.union(table)
    questions = placed.select("block", "text").mapInArrow(_ask_for_words(word_bits), _ROW).unionByName(
        store.coalesce(8).mapInArrow(_gram_store(word_bits), _ROW))
    if words is not None:
        questions = questions.unionByName(words["counts"].select("n", "data").mapInArrow(_word_store(word_bits), _ROW))
    characters = {"cuts": model["cuts"], "base": model["base"]}
    answers = [stored(questions.groupBy("shard").applyInArrow(_answers(characters), _ROW).drop("texts"), "kn-answers")]
    if words is not None:
        known = spark.sparkContext.broadcast(words["known"])
        drop_scratch(spark, *answers, since=mark)
        asked = placed.select("block", "text", "row.trusted").mapInArrow(_ask_for_pairs(bits, known), _ROW)
        answers.append(stored(asked.groupBy("shard").applyInArrow(_answers(), _ROW).drop("texts"), "kn-pair-answers"))
        words = {k: v for k, v in words.items() if k != "counts"} | {"known": known}
    drop_scratch(spark, *answers, since=mark)
    answered = answers[0]
    for table in answers[1:]:
        answered = answered.unionByName(table)
    row_type = placed.schema["row"].dataType.simpleString()
    payloads = placed.mapInArrow(_payloads, f"block long, rows array<{row_type}>, sizes array<long>, data binary")
    scored = (payloads.groupBy("block").cogroup(answered.groupBy("block"))
              .applyInArrow(_scorer(words), f"row {row_type}, logp double, n_symbols long"))
    return scored.select("row.*", "n_symbols", F.when(F.col("n_symbols") > 0, F.exp(-F.col("logp") / F.col("n_symbols"))).alias("perplexity"))


def _positions(docs: DataFrame) -> Column:
    """(file, unit) of each row as it is read, null where the rows do not come straight from files that tell."""
    found = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.floor(F.col("_metadata.row_index") / UNIT_ROWS).alias("unit"))
    try:
        docs.select(found).schema  # noqa: B018
    except AnalysisException:
        return F.lit(None).cast("struct<file: long, unit: long>")
    return found


def classify_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """One row per input row: doc_id, lang, n_symbols, perplexity, threshold, keep.

    Trusted documents are those labelled quality 1; the threshold of a language is the
    quantile of their perplexities (rounded up to two digits), that of a language without any
    (a null lang is a language too) is the one over all.  A text without words has a null
    perplexity and is not kept; without trusted text everything with words is kept.  Repeated
    rows give repeated results, an empty table none; other columns are ignored.
    """
    trusted_ids = labels.where("quality = 1").select("doc_id").distinct()
    if trusted_ids.count() <= BROADCAST_IDS:
        trusted_ids = F.broadcast(trusted_ids)
    base = docs.select("doc_id", "lang", "text", _positions(docs).alias("at"))
    read = base.join(trusted_ids, "doc_id", "left_semi")
    mark = scratch_mark()
    model, words = train_ngram_model(read), train_word_model(read)
    marked = base.join(trusted_ids.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn(
        "trusted", F.coalesce("trusted", F.lit(False)))
    scored = document_perplexities(marked, model, ["doc_id", "lang", "trusted"], words)
    drop_scratch(docs.sparkSession, scored, since=mark)
    scored = stored(scored, "kn-documents")
    trusted = (scored.where("trusted AND perplexity IS NOT NULL")
               .groupBy("lang", (F.ceil(F.col("perplexity") * 100) / 100).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    at = lambda: F.percentile("value", F.lit(quantile), F.col("n"))
    trusted = stored(trusted, "kn-trusted")
    by_lang = trusted.groupBy("lang").agg(at().alias("own"))
    everywhere = trusted.agg(at().alias("overall"))
    # one row per language, and one row
    out = scored.join(F.broadcast(by_lang.withColumnRenamed("lang", "of")), F.col("lang").eqNullSafe(F.col("of")), "left") \
        .crossJoin(F.broadcast(everywhere))
    threshold: Column = F.coalesce("own", "overall")
    return out.select("doc_id", "lang", "n_symbols", "perplexity", threshold.alias("threshold"),
                      F.when(F.col("perplexity").isNull(), False).otherwise(F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("keep"))
