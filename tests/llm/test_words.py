import random
import re

import numpy as np

from logsmith.llm import words as W


def test_words_and_shingles_follow_the_pattern():
    rng = random.Random(3)
    texts = ["", None, "Été  A\tB\nb", " x", "y ", "word" * 3] + [
        "".join(rng.choice("aB é\t\n\x0b.") for _ in range(rng.randrange(400))) for _ in range(60)]
    hashes, offsets, starts, ends = W.word_hashes(texts, spans=True)
    seen = {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        expected = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        a, b = offsets[i], offsets[i + 1]
        assert list(zip(starts[a:b], ends[a:b])) == expected
        for h, (s, e) in zip(hashes[a:b].tolist(), expected):
            assert seen.setdefault(h, raw[s:e].lower()) == raw[s:e].lower()
    assert len(set(seen.values())) == len(seen)
    sets = W.shingle_sets(texts, 5)
    for i, s in enumerate(sets):
        w = hashes[offsets[i]:offsets[i + 1]].tolist()
        assert len(s) == len({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else ())


def test_pieces_do_not_change_hashes(monkeypatch):
    texts = ["ab " * 500, "q" * 3000 + " z", "", "one two"]
    whole = W.word_hashes(texts)
    monkeypatch.setattr(W, "PIECE_BYTES", 64)
    W._tables.clear()
    cut = W.word_hashes(texts)
    W._tables.clear()
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 100, 200)
    for width in (1, 2, 5, 27, 28):
        assert W.sliding(x, width, np.minimum).tolist() == [x[i:i + width].min() for i in range(len(x) - width + 1)]
