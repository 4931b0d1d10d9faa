"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a table.

A stage gets what the stage before it wrote, so at its start the scratch tables of the stages
before are deleted; its own stay until the next one starts, as its result reads them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsmith.scratch import drop_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """Clears the scratch tables of earlier stages first; those that ``docs`` itself reads stay."""
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, docs)
        return fn(spark, docs, sf_dir)
    return run


@stage
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which language ID finds no language: null texts and texts without a letter.

    Learns from ``docs`` itself; every row with a predicted language stays, with its own columns.
    """
    from logsmith.llm.language_crf import UNDETERMINED, predict_languages, train_language_model
    model = train_language_model(docs)
    return predict_languages(docs, model, keep=docs.columns).where(
        F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram Jaccard join stays: that of the smallest doc_id."""
    from logsmith.llm.ngram_join import keep_one_per_group
    return keep_one_per_group(docs)


@stage
def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; n_chars follows the text, every row stays."""
    from logsmith.llm.substring_dedup import remove_repeats
    cut = remove_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return cut.select(*docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix, repeated as drawn."""
    from logsmith.llm.mixing import mix_documents
    return mix_documents(docs).select(*docs.columns)


@stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the piece ids of the text, their number, and whether decoding gives the text back."""
    from logsmith.llm.sentencepiece_wfst import encode_documents
    return encode_documents(docs)
