"""Parse, projections and profiles.

Pure functions ``DataFrame -> DataFrame``; the input of the parsers is any
DataFrame with a ``value: string`` column (``spark.read.text``, a stream, or
the fixture lines).  Parsing is a narrow transformation: no shuffle, one regex
pass per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsmith.functions import logline as L

LOG_COLUMNS = ["ip", "timestamp", "method", "url", "protocol", "status", "bytes",
               "hour", "day_of_week", "date", "is_error", "status_category"]


def parse_fields(lines: DataFrame) -> DataFrame:
    """The nine raw groups per line, ``''`` everywhere for a line that does not match."""
    # The split array is computed once in its own projection; Catalyst keeps the
    # two projections apart rather than inlining the regex nine times.
    parts = lines.select(L.split_fields(F.col("value")).alias("_parts"))
    matched = L.is_match(F.col("_parts"))
    return parts.select(*[F.when(matched, L.unescape(F.get(F.col("_parts"), i))).otherwise(F.lit("")).alias(n)
                          for i, n in enumerate(L.FIELD_NAMES)])


def matched_fields(lines: DataFrame) -> DataFrame:
    """The nine groups of matching lines only.

    Exploding the 0-or-1 element array keeps matching lines, and a filter above a
    generator is not pushed below it, so the regex runs exactly once per line
    (a plain filter on the fields would be pushed under the projection and
    re-evaluate the whole parse inside the predicate).
    """
    parts = lines.select(F.explode(L.matched_parts(F.col("value"))).alias("_parts"))
    return parts.select(*[L.unescape(F.get(F.col("_parts"), i)).alias(n)
                          for i, n in enumerate(L.FIELD_NAMES)])


def _typed(fields: DataFrame) -> DataFrame:
    """P2 + P3: keep matched lines (non-empty host and time), type the fields."""
    return (fields
            .filter((F.col("ip") != "") & (F.col("timestamp_str") != ""))
            .select("ip",
                    L.parse_time(F.col("timestamp_str")).alias("timestamp"),
                    "method", "url", "protocol",
                    L.parse_status(F.col("status_str")).alias("status"),
                    L.parse_bytes(F.col("bytes_str")).alias("bytes")))


def enrich(df: DataFrame) -> DataFrame:
    """Time and status enrichment."""
    return df.select(
        "*",
        F.hour("timestamp").alias("hour"),
        F.dayofweek("timestamp").alias("day_of_week"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("date"),
        L.is_error(F.col("status")).alias("is_error"),
        L.status_category(F.col("status")).alias("status_category"))


def parse_logs(lines: DataFrame) -> DataFrame:
    """P5: lines -> the 12-column ``logs`` table (``timestamp`` is an instant)."""
    return enrich(_typed(matched_fields(lines)))


def parse_stream(lines: DataFrame) -> DataFrame:
    """The streaming projection: the same parse plus ``processing_time``."""
    typed = _typed(matched_fields(lines))
    return typed.select(
        "ip", "timestamp", "method", "url", "protocol", "status", "bytes",
        F.current_timestamp().alias("processing_time"),
        F.hour("timestamp").alias("hour"),
        L.is_error(F.col("status")).alias("is_error"))


def parse_rejects(lines: DataFrame) -> DataFrame:
    """Accepted and rejected line counts (the reference drops rejects silently)."""
    fields = parse_fields(lines)
    accepted = (F.col("ip") != "") & (F.col("timestamp_str") != "")
    return (fields.select(F.coalesce(accepted, F.lit(False)).alias("accepted"))
            .groupBy("accepted").agg(F.count(F.lit(1)).alias("line_count")))


def log_profile(logs: DataFrame) -> DataFrame:
    """Per column row count, NULL count and exact distinct count.

    Written as a long (column, value) table aggregated twice, so each column's
    distinct values are spread over the cluster by (column, value) and partially
    aggregated before the shuffle, instead of one distinct set per column.
    """
    cols = logs.columns
    pairs = logs.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols
    ])).alias("p")).select("p.column_name", "p.v")
    per_value = pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("distinct_count"))


def describe_columns(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, sample stddev, min and max per numeric column, long form.

    One aggregation pass for all columns (algebraic aggregates, partial on the map
    side); the one-row result is then turned into one row per column.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
                 F.round(F.col(f"{c}__mean"), digits).alias("mean"),
                 F.round(F.col(f"{c}__stddev"), digits).alias("stddev"),
                 F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in columns]))
    return wide.select(rows.alias("r")).select("r.*")


def filter_logs(logs: DataFrame, start: str | None = None, end: str | None = None,
                ip: str | None = None, status: int | None = None) -> DataFrame:
    """The dashboard filters (time range ``[start, end)``, ip, status), all optional.

    ``start`` and ``end`` are anything Spark reads as a timestamp, with an offset or without
    (then UTC).
    """
    cond = F.lit(True)
    # The ``date`` bounds are implied by the time range (``date`` is the UTC day of
    # ``timestamp``), taken from the instant; they fold to literals and let a
    # date-partitioned table skip whole days.
    def day(bound):
        return F.date_format(F.to_timestamp(F.lit(bound)), "yyyy-MM-dd")

    if start is not None:
        cond = cond & (F.col("timestamp") >= F.to_timestamp(F.lit(start))) & (F.col("date") >= day(start))
    if end is not None:
        cond = cond & (F.col("timestamp") < F.to_timestamp(F.lit(end))) & (F.col("date") <= day(end))
    if ip is not None:
        cond = cond & (F.col("ip") == ip)
    if status is not None:
        cond = cond & (F.col("status") == status)
    return logs.filter(cond)
