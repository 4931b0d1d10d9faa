"""Mergeable summaries of long ranges: heavy hitters (A3, A4) and quantiles.

Both are small tables, one part per hour, that are merged on demand; the logs of the range are
read again only where an exact answer needs them.

A heavy-hitter summary keeps the ``capacity`` largest items of a span.  ``n`` is a lower bound
of an item's count, ``n + error`` an upper one, and ``missed`` an upper bound for every item that
is not there.  Merging adds the bounds, an item absent from a part taking that part's ``missed``,
and cuts again (a space-saving summary: errors add up, and stay known).  The exact top k then
needs one scan with the few items whose upper bound reaches the k-th lower bound; if an unseen
item could be among them, the scan takes all items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsmith.operators.common import quantile_of_sketch, rank_sketch
from logsmith.scratch import stored

#: Items that a summary keeps per span.
CAPACITY = 1000


def item_summaries(logs: DataFrame, key: str, span: str = "hour", capacity: int = CAPACITY) -> DataFrame:
    """Rows (span, item, n, error, missed): the largest counts of ``key`` per span of time.

    Rows without a timestamp form the NULL span.  Counts are partial aggregates and the cut is a
    group limit before the shuffle, so neither a hot item nor a hot hour meets whole in one task.
    """
    counts = logs.groupBy(F.date_trunc(span, F.col("timestamp")).alias("span"), F.col(key).alias("item")).agg(
        F.count(F.lit(1)).alias("n"))
    return _cut(counts.withColumn("error", F.lit(0).cast("long")), F.lit(0).cast("long"), capacity)


def _cut(counts: DataFrame, unseen: Column, capacity: int) -> DataFrame:
    """The ``capacity`` items of each span with the largest upper bounds; ``unseen`` bounds items not in ``counts``."""
    upper = F.col("n") + F.col("error")
    span = Window.partitionBy("span")
    ranked = (counts.withColumn("unseen", unseen).withColumn("upper", upper)
              .withColumn("no", F.row_number().over(span.orderBy(F.desc("upper"), F.asc("item"))))
              .where(F.col("no") <= capacity + 1))
    cut_off = F.coalesce(F.max(F.when(F.col("no") > capacity, F.col("upper"))).over(span), F.lit(0))
    return (ranked.withColumn("missed", F.greatest(cut_off, "unseen")).where(F.col("no") <= capacity)
            .select("span", "item", "n", "error", "missed"))


def merge_summaries(summaries: DataFrame, span: str | None = "day", capacity: int = CAPACITY) -> DataFrame:
    """Summaries of longer spans (``None``: one of everything) from those of shorter ones."""
    longer = F.date_trunc(span, F.col("span")) if span else F.lit(None).cast("timestamp")
    missed = (summaries.select("span", "missed").distinct().groupBy(longer.alias("to"))
              .agg(F.sum("missed").alias("all_missed")))
    items = summaries.groupBy(longer.alias("span"), "item").agg(
        F.sum("n").alias("n"), F.sum("error").alias("own_error"), F.sum("missed").alias("own_missed"))
    both = items.join(missed, F.col("span").eqNullSafe(F.col("to")))
    counts = both.select("span", "item", "n", (F.col("own_error") + F.col("all_missed") - F.col("own_missed")).alias("error"),
                         "all_missed")
    return _cut(counts, F.col("all_missed"), capacity)


def exact_top(logs: DataFrame, summary: DataFrame, key: str, k: int,
              report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``report`` of the logs of all items that can be among the top ``k`` by count.

    ``summary`` is one merged summary of exactly these logs.  ``report`` (``kpis.top_urls``,
    ``kpis.top_ips``) counts them anew, so its result is that over all logs.
    """
    summary = stored(summary, "top-summary")
    # at most k rows and one bound come to the driver
    leaders = [r.n for r in summary.orderBy(F.desc("n")).limit(k).select("n").collect()]
    missed = summary.agg(F.max("missed")).first()[0] or 0
    reach = leaders[-1] if len(leaders) == k else 0
    if missed and missed >= reach:
        return report(logs)  # an item that the summary does not hold could be among them
    wanted = stored(summary.where(F.col("n") + F.col("error") >= reach).select(F.col("item").alias(key)), "top-wanted")
    return report(logs.join(wanted, key, "left_semi"))


def hourly_rank_sketches(per_minute: DataFrame) -> DataFrame:
    """Rows (date, hour of the minutes' text, sketch) of requests per minute; merge with ``merged_threshold``."""
    return per_minute.groupBy(F.substring("minute", 1, 13).alias("hour")).agg(rank_sketch("access_count").alias("sketch"))


def merged_threshold(sketches: DataFrame, percentile: float) -> DataFrame:
    """One row ``threshold``: the percentile over all spans of ``sketches``, within RANK_ERROR."""
    return sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch")).select(
        quantile_of_sketch(F.col("sketch"), percentile).alias("threshold"))
