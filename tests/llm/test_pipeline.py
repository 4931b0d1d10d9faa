from edge import edge_docs, empty_docs
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from logsmith.llm import stages
from logsmith.llm.sentencepiece_wfst import MODEL_PATH


def staged(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], "").cache())
    return out


def test_stages_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, known, single, cut, mixed, encoded = staged(spark, docs)
    assert all(d.columns == docs.columns for d in (known, single, cut, mixed))
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    assert ids(known) == ids(docs)                   # every document of the table has letters
    assert set(ids(single)) < set(ids(known)) and ids(cut) == ids(single)
    assert set(ids(mixed)) <= set(ids(cut)) and encoded.count() == mixed.count()
    assert cut.where("n_chars != char_length(text)").count() == 0
    library = SentencePieceProcessor(model_file=MODEL_PATH)
    text = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.pieces == library.encode(text[r.doc_id]) for r in encoded.collect())


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lambda d: sorted((r.doc_id, tuple(r.pieces)) for r in d.collect())
    assert rows(corpus_pipeline.run(spark, sf)) == rows(staged(spark, docs)[-1])


def test_edge_cases(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        tables = staged(spark, docs)
        assert all(d.columns == docs.columns for d in tables[:-1])
    assert tables[-1].collect() == []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "substring_dedup",
                                                      "mix_sources", "sentencepiece"]
    assert stages.keep_known_languages(spark, edge_docs(spark), "").where("doc_id in (0, 1, 2, 3, 13)").count() == 0
