"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer composes three parts, compiled once from a model file:

* the *normaliser*: a dummy space in front (if the model asks for one), then space to U+2581;
* the *pieces*: a trie whose arcs read characters and whose accepting states write a piece;
* *byte fallback*: a character that no piece covers writes the pieces of its UTF-8 bytes.

Composed with an input, its states are (place, last piece).  In the tropical semiring an arc
from last piece p to next piece q weighs 0 where the model itself would encode the string pq
as exactly p, q, and infinity elsewhere.  A segmentation is the model's merge (BPE) encoding
exactly if all its neighbouring pieces have weight 0 (merges are executed best score first,
and the best merge of a whole text that lies in pq is also the best one of pq alone; so no
merge ever crosses the boundary).  Hence each place has one state of finite distance, and the
shortest path is found by one pass over places, without the merge loop.

No piece holds a U+2581 after another character, so the composition falls apart before each
run of U+2581, and each distinct word is solved once; numpy relaxes the arcs of all distinct
words of a batch together.  Pair weights are computed when first needed and kept in a
fixed-size cache of the worker process.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logsmith.llm.common import small_arrow_batches
from logsmith.llm.words import span_hashes

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters that no piece covers get the ids CHAR_IDS + code point inside the transducer.
CHAR_IDS = 1 << 20
LONG_WORD = 64
PAIR_SLOTS_LOG2 = 21
WORD_CACHE = 1_500_000
BATCH_CHARS = 8_000_000
_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


class PieceModel:
    """The compiled transducer; plain data, so it can be broadcast."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool, byte_fallback: bool, unknown: int):
        # piece kinds: 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
        if any(kind in (4, 5) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.dummy_prefix, self.unknown = dummy_prefix, unknown
        self.names = [name for name, _, _ in pieces]
        self.score = {name: score for name, score, kind in pieces if kind == 1}
        self.ids = {name: i for i, (name, _, kind) in enumerate(pieces) if kind == 1}
        self.byte_ids = ([i for _, i in sorted((int(name[3:5], 16), i) for i, (name, _, kind) in enumerate(pieces) if kind == 6)]
                         if byte_fallback else [])
        self.decoded = [name.replace(SPACE, " ").encode() if kind == 1 else bytes([int(name[3:5], 16)]) if kind == 6
                        else " ⁇ ".encode() if kind == 2 else b"" for name, _, kind in pieces]
        self.parts_at_space = not any(SPACE in name.lstrip(SPACE) for name in self.ids)
        self.parts_at_feed = not any("\n" in name for name in self.ids)
        # pieces that their own string is not encoded as can stand in no encoding
        self.ids = {name: i for name, i in self.ids.items() if self.merged(name) == [name]}
        trie = {name[:n] for name in self.ids for n in range(1, len(name) + 1)}
        self.longest = max(map(len, self.ids), default=1)
        hashes = {self._hash(x): self.ids.get(x, -1) for x in trie}
        self.trie_hash = np.array(sorted(hashes), dtype=np.uint64)
        self.trie_piece = np.array([hashes[int(h)] for h in self.trie_hash], dtype=np.int64)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for ch in text:
            h = ((h + ord(ch) + 1) * int(_HASH_BASE)) & (2 ** 64 - 1)
            h ^= h >> 29
        return h

    def merged(self, text: str) -> list[str]:
        """The merge encoding by its definition: best score first, leftmost on ties."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def string(self, piece: int) -> str:
        return self.names[piece] if piece < CHAR_IDS else chr(piece - CHAR_IDS)

    def weight_is_zero(self, left: int, right: int) -> bool:
        a, b = self.string(left), self.string(right)
        return self.merged(a + b) == [a, b]

    def fallback(self, piece: int) -> list[int]:
        if piece < CHAR_IDS:
            return [piece]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in chr(piece - CHAR_IDS).encode("utf-8", "surrogatepass")]


def load_model(path: str = MODEL_PATH) -> PieceModel:
    """Compile a SentencePiece BPE model file (read on the driver)."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, trainer = proto.normalizer_spec, proto.trainer_spec
    if trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
            or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with an identity normaliser are supported")
    return PieceModel([(p.piece, p.score, p.type) for p in proto.pieces], norm.add_dummy_prefix,
                      trainer.byte_fallback, trainer.unk_id)


class Encoder:
    """Shortest paths for many words at a time, with caches of bounded size."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.pair_key = np.full(1 << PAIR_SLOTS_LOG2, -1, dtype=np.int64)
        self.pair_zero = np.zeros(1 << PAIR_SLOTS_LOG2, dtype=bool)
        self.reset()

    def reset(self) -> None:
        # known words by hash, in two sorted runs: the short one takes new words
        self.runs = [(np.empty(0, np.uint64), np.empty(0, np.int64)) for _ in range(2)]
        self.flat, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _zero(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the arcs left -> right weigh 0."""
        key = (left << 22) | right
        slot = ((key.astype(np.uint64) * _HASH_BASE) >> np.uint64(64 - PAIR_SLOTS_LOG2)).astype(np.int64)
        out = self.pair_zero[slot]
        missing = np.flatnonzero(self.pair_key[slot] != key)
        if len(missing):
            new, inverse = np.unique(key[missing], return_inverse=True)
            mask = (1 << 22) - 1
            value = np.fromiter((self.model.weight_is_zero(k >> 22, k & mask) for k in new.tolist()), bool, len(new))
            out[missing] = value[inverse]
            self.pair_key[slot[missing]] = key[missing]
            self.pair_zero[slot[missing]] = out[missing]
        return out

    def _solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat pieces of short words and the bounds of each."""
        m = self.model
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        total = len(code)
        begin, end = np.repeat(first, size), np.repeat(first + size, size)
        # composition with the trie: all arcs (start, stop, piece)
        at, h = np.arange(total), np.zeros(total, np.uint64)
        arcs = []
        for n in range(1, m.longest + 1):
            h = (h + code[at + n - 1].astype(np.uint64) + np.uint64(1)) * _HASH_BASE
            h ^= h >> np.uint64(29)
            state = np.minimum(np.searchsorted(m.trie_hash, h), len(m.trie_hash) - 1)
            known = m.trie_hash[state] == h
            piece = np.where(known, m.trie_piece[state], -1)
            if n == 1:
                piece = np.where(piece < 0, CHAR_IDS + code, piece)
            some = piece >= 0
            arcs.append((at[some], at[some] + n, piece[some]))
            goes = known & (at + n < end[at])
            at, h = at[goes], h[goes]
            if not len(at):
                break
        start, stop, piece = (np.concatenate(x) for x in zip(*arcs))
        step = stop - begin[start]
        order = np.argsort(step, kind="stable")
        start, stop, piece, step = start[order], stop[order], piece[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(size.max()) + 2))
        # last[p], source[p]: piece and start of the finite path that ends at place p of its word
        last, source = np.full(total + 1, -1, np.int64), np.full(total + 1, -1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, e, p = start[a:b], stop[a:b], piece[a:b]
            inner = np.flatnonzero(s > begin[s])
            finite = np.ones(b - a, dtype=bool)
            if len(inner):
                # a word's places are numbered by the character before them
                finite[inner] = self._zero(last[s[inner] - 1], p[inner])
            last[e[finite] - 1], source[e[finite] - 1] = p[finite], s[finite]
        # walk all paths back from the words' ends
        owner, where, found = [], [], []
        words_left, place = np.arange(len(words)), first + size
        while len(words_left):
            owner.append(words_left)
            where.append(place)
            found.append(last[place - 1])
            place = source[place - 1]
            go = place > first[words_left]
            words_left, place = words_left[go], place[go]
        owner, where, found = np.concatenate(owner), np.concatenate(where), np.concatenate(found)
        order = np.argsort(where, kind="stable")
        owner, found = owner[order], found[order]
        return found, np.searchsorted(owner, np.arange(len(words) + 1))

    def _solve_long(self, word: str) -> list[int]:
        """The same pass for one word of any length."""
        m = self.model
        last, source = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        known: dict[tuple[int, int], bool] = {}
        for stop in range(1, len(word) + 1):
            for start in range(stop - 1, max(-1, stop - m.longest - 1), -1):
                piece = m.ids.get(word[start:stop])
                if piece is None:
                    if stop - start > 1:
                        continue
                    piece = CHAR_IDS + ord(word[start])
                if start:
                    pair = (last[start], piece)
                    if pair not in known:
                        if len(known) > 100_000:
                            known.clear()
                        known[pair] = m.weight_is_zero(*pair)
                    if not known[pair]:
                        continue
                last[stop], source[stop] = piece, start
        out, place = [], len(word)
        while place:
            out.append(last[place])
            place = source[place]
        return out[::-1]

    def _learn(self, words: list[str]) -> None:
        """Append the pieces of new words to the cache, short words first."""
        short = [w for w in words if len(w) <= LONG_WORD]
        parts, ends = [self.flat], [self.bounds]
        if short:
            found, bounds = self._solve(short)
            odd = np.flatnonzero(found >= CHAR_IDS)
            if len(odd):  # spell out the characters that no piece covers
                count = np.ones(len(found), np.int64)
                spelt = [self.model.fallback(int(p)) for p in found[odd]]
                count[odd] = list(map(len, spelt))
                at = np.cumsum(count) - count
                out = np.repeat(found, count)
                for i, ids in zip(odd, spelt):
                    out[at[i]:at[i] + len(ids)] = ids
                found, bounds = out, np.append(at, len(out))[bounds]
            parts.append(found.astype(np.int32))
            ends.append(bounds[1:] + ends[-1][-1])
        for w in words:
            if len(w) > LONG_WORD:
                ids = [i for p in self._solve_long(w) for i in self.model.fallback(p)]
                parts.append(np.array(ids, np.int32))
                ends.append(np.array([ends[-1][-1] + len(ids)]))
        self.flat, self.bounds = np.concatenate(parts), np.concatenate(ends)

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes, -1 if not known."""
        out = np.full(len(hashes), -1, np.int64)
        for keys, numbers in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, numbers[at], out)
        return out

    def _remember(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        def merged(x, y):
            keys, values = np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])
            order = np.argsort(keys, kind="stable")
            return keys[order], values[order]
        self.runs[1] = merged(self.runs[1], (hashes, numbers))
        if len(self.runs[1][0]) * 4 > len(self.runs[0][0]):
            self.runs = [merged(*self.runs), (np.empty(0, np.uint64), np.empty(0, np.int64))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat piece ids of all texts and the bounds of each text."""
        m = self.model
        # space and U+2581 are one character to the model: spaces stand for both in the stream
        front = " " if m.dummy_prefix else ""
        raw = [(front + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        begins = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(list(map(len, raw)), out=begins[1:])
        data = np.frombuffer(b"".join(raw), np.uint8)
        # words: no piece lies across their starts
        starts_here = np.zeros(len(data) + 1, dtype=bool)
        starts_here[begins] = True
        if m.parts_at_space:
            blank = data == 0x20
            starts_here[1:-1] |= blank[1:] & ~blank[:-1]
        if m.parts_at_feed:
            feed = np.flatnonzero(data == 0x0A)
            starts_here[feed] = starts_here[feed + 1] = True
        starts_here[len(data)] = False
        starts = np.flatnonzero(starts_here)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        hashes = span_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.bounds) > WORD_CACHE:
            self.reset()
        numbers = self._numbers(distinct)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            stream = data.tobytes()
            words = [stream[a:b].decode("utf-8", "surrogatepass").replace(" ", SPACE)
                     for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            size = np.fromiter(map(len, words), np.int64, len(words))
            order = np.argsort(size > LONG_WORD, kind="stable")  # as _learn numbers them
            at = len(self.bounds) - 1
            self._learn(words)
            numbers[new[order]] = at + np.arange(len(new))
            self._remember(distinct[new], numbers[new])
        words = numbers[inverse]
        count = self.bounds[words + 1] - self.bounds[words]
        upto = np.cumsum(count)
        flat = self.flat[np.arange(int(upto[-1])) - np.repeat(upto - count - self.bounds[words], count)]
        return flat, np.concatenate(([0], upto))[np.searchsorted(starts, begins)]


def decode(model: PieceModel, ids: list[int]) -> str:
    """The text of piece ids: pieces and bytes joined, U+2581 to space, the dummy space dropped.

    Bytes that are no UTF-8 become U+FFFD.
    """
    text = b"".join([model.decoded[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text.startswith(" ") else text


def _worker_encoder(model: PieceModel) -> Encoder:
    """The worker process's encoder: its caches outlive a task."""
    held = sys.modules.setdefault("_piece_encoder", types.ModuleType("_piece_encoder"))
    if getattr(held, "names", None) != model.names:
        held.encoder, held.names = Encoder(model), model.names
    return held.encoder


def encode_documents(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """One row per input row: doc_id, n_pieces, pieces, round_trip.

    ``pieces`` are the ids of the whole text; ``round_trip`` tells whether decoding them gives
    the text back (it does unless the text itself holds U+2581).  A null text has null pieces
    and round_trip, and 0 pieces; an empty text has none and comes back.  Repeated rows give
    repeated results, an empty table none; other columns are ignored.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(load_model(model_path))

    def run(batches):
        encoder = _worker_encoder(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            size = np.cumsum([0 if t is None else len(t) for t in texts]) // BATCH_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield answer(encoder, batch.column(0)[a:b], texts[a:b])

    def answer(encoder, ids, texts):
        flat, bounds = encoder.encode(["" if t is None else t for t in texts])
        listed = flat.tolist()
        same = [None if t is None else decode(encoder.model, listed[a:b]) == t
                for t, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist())]
        null = np.array([t is None for t in texts] + [False])
        pieces = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=null), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(bounds), pa.int64()), pieces, pa.array(same, pa.bool_())],
            names=["doc_id", "n_pieces", "pieces", "round_trip"])

    schema = T.StructType([docs.select("doc_id").schema["doc_id"], T.StructField("n_pieces", T.LongType()),
                           T.StructField("pieces", T.ArrayType(T.IntegerType())),
                           T.StructField("round_trip", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
