"""Connected components of an undirected graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsmith.scratch import drop_scratch, scratch_mark, stored


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each component is a star around its smallest node: no node is both an upper
    and a lower end, or an upper end twice."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("upper")).union(
        edges.select(F.col("b").alias("node"), F.lit(1).alias("upper")))
    wrong = (ends.groupBy("node").agg(F.min("upper").alias("low"), F.sum("upper").alias("ups"))
             .where("ups > 1 OR (ups = 1 AND low = 0)"))
    return not wrong.limit(1).count()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph: rows (node, component), component the smallest node.

    ``edges`` holds pairs of longs; loops and repeats are allowed, rows with a null end are
    ignored, and only nodes with an edge to another node are returned.  Large-star steps (each
    node links its larger neighbours to its smallest one) and small-star steps (each node
    links itself and its smaller neighbours to the smallest) alternate until every component
    is a star, with no cap on rounds.  Every minimum is a partial aggregation and every join
    has stored tables on both sides, so a hub or a giant component is split by the adaptive
    skew join; nothing is collected.  An empty graph gives no rows.
    """
    mark = scratch_mark()
    e = stored(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
               .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a < b").distinct(), "cc-edges")
    while not _is_star_forest(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("low")), "cc-low")
        large = stored(e.join(low, "a").select(F.least("a", "low").alias("a"), "b").distinct(), "cc-large")
        low = stored(large.groupBy("b").agg(F.min("a").alias("low")), "cc-low")
        small = large.join(low, "b").select("a", "b", "low")
        e = stored(small.select(F.col("low").alias("a"), "b")
                   .union(small.where("low < a").select(F.col("low").alias("a"), F.col("a").alias("b")))
                   .distinct(), "cc-edges")
        drop_scratch(e.sparkSession, e, since=mark)  # the last round's tables
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
