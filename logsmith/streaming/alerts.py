"""Alerts on the live stream (D5, D7): two chained stateful aggregations in append mode.

The first counts requests and errors per minute.  The second slides a window of
``for_minutes + 1`` minutes over those rows, one minute at a time, and keeps a bit for every
breaching minute: all bits but that of the first minute set means that the alert fires at the
window's last minute, all but that of the last that it fired a minute before.  The state holds
one row per open minute and a few words per open window, whatever the traffic; log lines are
never multiplied, minute rows are.

A minute is judged once the watermark has passed it, so no row is ever taken back.  Minutes
without traffic breach nothing; the first ones after traffic are judged like any other, so an
alert is resolved by silence too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsmith.functions.logline import minute_of
from logsmith.streaming.stream import WATERMARK


def error_rate_above(max_error_rate: float = 0.10) -> Callable[[Column, Column], Column]:
    """Breach of (requests, errors) when more than this share are errors."""
    return lambda requests, errors: F.try_divide(errors.cast("double"), requests.cast("double")) > max_error_rate


def requests_above(threshold: float) -> Callable[[Column, Column], Column]:
    """Breach when a minute has more requests."""
    return lambda requests, errors: requests > threshold


def live_alerts(parsed: DataFrame, breach: Callable[[Column, Column], Column], for_minutes: int = 5,
                watermark: str = WATERMARK) -> DataFrame:
    """One row per judged minute: minute_start, minute, request_count, error_count, breach, firing, event.

    firing is 1 when the minute and the ``for_minutes - 1`` before it all breach (at most 60);
    event is ``firing`` at the first such minute, ``resolved`` at the first after them, else
    NULL.  Judged are all minutes with traffic and the ``for_minutes`` minutes after one.
    """
    if not 1 <= for_minutes <= 60:
        raise ValueError("for_minutes must be between 1 and 60")
    size = for_minutes + 1
    per_minute = (parsed.withWatermark("timestamp", watermark).groupBy(F.window("timestamp", "1 minute"))
                  .agg(F.count(F.lit(1)).alias("request_count"), F.sum("is_error").alias("error_count")))
    number = F.floor(F.unix_timestamp(F.col("window.start")) / 60)
    rows = per_minute.select(
        F.col("window"), F.struct(number.alias("no"), "request_count", "error_count").alias("at"),
        F.when(breach(F.col("request_count"), F.col("error_count")),
               F.expr(f"shiftleft(1L, cast(pmod(floor(unix_timestamp(window.start) / 60), {size}) AS int))"))
        .otherwise(F.lit(0).cast("long")).alias("bit"))
    judged = (rows.groupBy(F.window(F.window_time("window"), f"{size} minutes", "1 minute"))
              .agg(F.bit_or("bit").alias("bits"), F.max("at").alias("last")))
    first = F.expr(f"shiftleft(1L, cast(pmod(floor(unix_timestamp(window.start) / 60), {size}) AS int))")
    final = F.expr(f"shiftleft(1L, cast(pmod(floor(unix_timestamp(window.start) / 60) + {for_minutes}, {size}) AS int))")
    every = F.lit((1 << size) - 1).cast("long")
    now = F.col("bits").bitwiseOR(first) == every
    before = F.col("bits").bitwiseOR(final) == every
    start = F.col("window.end") - F.expr("INTERVAL 1 MINUTE")
    traffic = F.col("last.no") == F.floor(F.unix_timestamp(start) / 60)
    return judged.select(
        start.alias("minute_start"), minute_of(start).alias("minute"),
        F.when(traffic, F.col("last.request_count")).otherwise(0).cast("long").alias("request_count"),
        F.when(traffic, F.col("last.error_count")).otherwise(0).cast("long").alias("error_count"),
        (F.col("bits").bitwiseAND(final) != 0).cast("int").alias("breach"), now.cast("int").alias("firing"),
        F.when(now & ~before, "firing").when(before & ~now, "resolved").alias("event"))
