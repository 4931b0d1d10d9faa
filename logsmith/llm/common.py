"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsmith.operators.components import connected_components
from logsmith.scratch import stored

__all__ = ["WORD_PATTERN", "connected_components", "crc_of_id", "let", "merge_components", "read_table", "small_arrow_batches", "stored",
           "text_chars"]

#: White space that parts words: 0x20 and 0x09-0x0D.  Everything else is part of a word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def merge_components(part: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components (node, component) after further links (a, b), and the (old, new) names of those that changed.

    A node that is not in ``part`` is a component of its own.
    """
    name = lambda x, y: part.select(F.col("node").alias(x), F.col("component").alias(y))
    bridges = (links.join(name("a", "pa"), "a", "left").join(name("b", "pb"), "b", "left")
               .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")))
    renamed = stored(connected_components(bridges), "merged-names").select(
        F.col("node").alias("old"), F.col("component").alias("new"))
    lone = renamed.select(F.col("old").alias("node")).join(part, "node", "left_anti")
    both = part.unionByName(lone.select("node", F.col("node").alias("component")))
    after = both.join(renamed, both["component"] == renamed["old"], "left").select(
        "node", F.coalesce("new", "component").alias("component"))
    return stored(after, "merged-parts"), renamed


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_arrow_batches(spark: SparkSession, rows: int = 400) -> None:
    """Bound the rows of one Arrow batch: texts can be very long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def crc_of_id(column: str | Column = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once (a lambda's outer expressions run for each element)."""
    return F.transform(F.array(value), body)[0]


def text_chars(texts: DataFrame) -> int:
    """Characters in all texts."""
    return texts.agg(F.sum(F.char_length("text"))).first()[0] or 0
