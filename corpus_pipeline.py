"""A corpus pipeline over ``documents``: language ID, near duplicates, repeated passages,
mixing to source weights, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsmith.llm.common import read_table, stored
from logsmith.llm.stages import (drop_near_duplicates, encode_pieces, keep_known_languages, mix_sources,
                                 remove_repeated_passages)

STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Model-based, hash-permuted and tokenising stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
