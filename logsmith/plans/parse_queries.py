"""Registered queries: scan, parse, profile, filters."""

from __future__ import annotations


from logsmith.operators import parsing
from logsmith.plans.oracle import with_fields, with_lines, with_logs
from logsmith.plans.registry import logs_table, register
from logsmith.session import scratch_path
from logsmith.sources.fixtures import event_log_lines
from logsmith.sources.logstore import read_logs_table, write_logs_table
from logsmith.sources.text import read_log_text, write_log_text

LOG_SELECT = ('ip, "timestamp", method, url, protocol, status, bytes, hour, day_of_week, date, '
              'is_error, status_category')


@register("scan_lines", "S1", with_lines("SELECT value FROM lines"))
def scan_lines(spark, sf_dir):
    """Lines written as plain text files to the shared scratch folder, then scanned back."""
    path = scratch_path(spark, "lines")
    write_log_text(event_log_lines(spark, sf_dir), path)
    return read_log_text(spark, path)


@register("parse_fields", "P1", with_fields(
    "SELECT ip, client_identity, user_id, timestamp_str, method, url, protocol, status_str, bytes_str "
    "FROM fields"))
def parse_fields(spark, sf_dir):
    return parsing.parse_fields(event_log_lines(spark, sf_dir))


@register("parse_logs", "P2 P3 P5", with_logs(f"SELECT {LOG_SELECT} FROM logs"))
def parse_logs(spark, sf_dir):
    return logs_table(spark, sf_dir)


@register("enrich_logs", "P4", with_logs(
    'SELECT ip, "timestamp", hour, day_of_week, date, is_error, status_category FROM logs'))
def enrich_logs(spark, sf_dir):
    return logs_table(spark, sf_dir).select(
        "ip", "timestamp", "hour", "day_of_week", "date", "is_error", "status_category")


@register("parse_rejects", "P7", with_fields(
    "SELECT coalesce(ip <> '' AND timestamp_str <> '', false) AS accepted, count(*) AS line_count "
    "FROM fields GROUP BY 1"))
def parse_rejects(spark, sf_dir):
    return parsing.parse_rejects(event_log_lines(spark, sf_dir))


def _profile_sql() -> str:
    cols = ["ip", "timestamp", "method", "url", "protocol", "status", "bytes", "hour",
            "day_of_week", "date", "is_error", "status_category"]
    parts = [f"SELECT '{c}' AS column_name, count(*) AS row_count, "
             f"count(*) - count(\"{c}\") AS null_count, count(DISTINCT \"{c}\") AS distinct_count FROM logs"
             for c in cols]
    return with_logs("\nUNION ALL\n".join(parts))


@register("log_profile", "P8", _profile_sql())
def log_profile(spark, sf_dir):
    return parsing.log_profile(logs_table(spark, sf_dir))


def _describe_sql(table: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(\"{c}\") AS count, "
             f"round(avg(CAST(\"{c}\" AS DOUBLE)), 6) AS mean, "
             f"round(stddev_samp(CAST(\"{c}\" AS DOUBLE)), 6) AS stddev, "
             f"round(CAST(min(\"{c}\") AS DOUBLE), 6) AS min, round(CAST(max(\"{c}\") AS DOUBLE), 6) AS max "
             f"FROM {table}"
             for c in columns]
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", "P9", with_logs(_describe_sql("logs", ["status", "bytes"])))
def describe_numeric(spark, sf_dir):
    return parsing.describe_columns(logs_table(spark, sf_dir), ["status", "bytes"])


# Dashboard filter (P13): one week of 404s, the panel variables of the reference.
FILTER_START, FILTER_END, FILTER_STATUS = "2024-01-08 00:00:00", "2024-01-15 00:00:00", 404


@register("filter_logs", "P13", with_logs(
    f"SELECT {LOG_SELECT} FROM logs WHERE \"timestamp\" >= TIMESTAMP '{FILTER_START}' "
    f"AND \"timestamp\" < TIMESTAMP '{FILTER_END}' AND status = {FILTER_STATUS}"))
def filter_logs(spark, sf_dir):
    return parsing.filter_logs(logs_table(spark, sf_dir), start=FILTER_START, end=FILTER_END,
                               status=FILTER_STATUS)


OFFSET_START, OFFSET_END = "2024-1-8 00:00:00+09:00", "2024-01-14 23:00:00-05:00"


@register("filter_logs_offset", "P13", with_logs(
    f"SELECT {LOG_SELECT} FROM logs WHERE \"timestamp\" >= TIMESTAMP '2024-01-07 15:00:00' "
    "AND \"timestamp\" < TIMESTAMP '2024-01-15 04:00:00'"))
def filter_logs_offset(spark, sf_dir):
    """Bounds with offsets and a one-digit month."""
    return parsing.filter_logs(logs_table(spark, sf_dir), start=OFFSET_START, end=OFFSET_END)


@register("stored_logs_filter", "P13 S3 (date-partitioned logs table)", with_logs(
    f"SELECT {LOG_SELECT} FROM logs WHERE \"timestamp\" >= TIMESTAMP '{FILTER_START}' "
    f"AND \"timestamp\" < TIMESTAMP '{FILTER_END}' AND status = {FILTER_STATUS}"))
def stored_logs_filter(spark, sf_dir):
    """The dashboard filter over the persisted table: days outside the range are
    pruned as directories, the status test is pushed into the Parquet scan."""
    path = scratch_path(spark, "logs-table")
    write_logs_table(logs_table(spark, sf_dir), path)
    return parsing.filter_logs(read_logs_table(spark, path), start=FILTER_START, end=FILTER_END,
                               status=FILTER_STATUS)
