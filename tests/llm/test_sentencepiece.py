import random

from edge import edge_docs, edge_rows, empty_docs
from sentencepiece import SentencePieceProcessor

from logsmith.llm.sentencepiece_wfst import MODEL_PATH, Encoder, decode, encode_documents, load_model

MODEL = load_model()
LIBRARY = SentencePieceProcessor(model_file=MODEL_PATH)


def ids(texts):
    flat, bounds = Encoder(MODEL).encode(texts)
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_equal_to_the_library():
    rng = random.Random(6)
    alphabet = "aabcdeiou  .,\n\tßéñ日本▁😀0123456789ATH" + "the ing "
    texts = ["", " ", "  ", "a", "Hello  world", "\n\n", " x ", "<s></s><0x0A>", "a" * 300, " " * 90 + "t", "x" * 70 + " y",
             "▁▁a", "\x00\x01", "naïve café\r\n"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(300)]
    for text, got in zip(texts, ids(texts)):
        assert got == LIBRARY.encode(text), text
        assert decode(MODEL, got) == LIBRARY.decode(got)


def test_whole_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in encode_documents(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(rows[i].pieces == LIBRARY.encode(t) and rows[i].round_trip for i, t in texts.items())


def test_cache_overflow_and_byte_sequences(monkeypatch):
    from logsmith.llm import sentencepiece_wfst as W
    monkeypatch.setattr(W, "WORD_CACHE", 3)
    encoder = Encoder(MODEL)
    for text in ("one two three four five", "six seven", "one 🜁 two", ""):
        flat, _ = encoder.encode([text])
        assert flat.tolist() == LIBRARY.encode(text)
    broken = [MODEL.byte_ids[0xE6], MODEL.byte_ids[0x41]]
    assert decode(MODEL, broken) == "�A"


def test_edge_cases(spark):
    got = encode_documents(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[0].pieces, by_id[0].n_pieces, by_id[0].round_trip) == (None, 0, None)
    assert (by_id[1].pieces, by_id[1].n_pieces, by_id[1].round_trip) == ([], 0, True)
    assert all(r.round_trip for r in got if r.pieces is not None)
    assert by_id[11].pieces == LIBRARY.encode(edge_rows()[11][1])
    assert encode_documents(empty_docs(spark)).collect() == []
