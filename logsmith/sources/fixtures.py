"""Access-log lines derived from the driver's ``events`` table.

The test tables hold no web-server log, so one NCSA common-log line is built
per event, column-wise, with built-in functions only (no Python per row).  The
rule is the same one the DuckDB oracle text in ``plans/oracle.py`` applies,
so both engines see byte-identical input:

  whole line   event_id % 101 = 0   -> ``junk <event_id>`` (rejected by the parser)
  host         user_id < 20         -> ``10.0.0.1`` (one heavy client)
               user_id % 3 = 0      -> ``host-<user_id>.example.com``
               otherwise            -> ``10.0.1.<user_id>``
  time         ``dd/MMM/yyyy:HH:mm:ss +0000`` of ``ts``
  request      ``POST`` for purchase/signup else ``GET``; url ``/<event_type>/<k>``;
               protocol ``HTTP/1.0`` unless event_id % 53 = 0 (two-token request)
  status       event_id % 97 = 0 -> ``-``; user_id % 25 = 22 -> 403;
               error -> 404 (even user) / 500 (odd user); click -> 302; else 200
  bytes        event_id % 13 = 0 -> ``-``; else floor(value * 100)

Every event yields exactly one line; nothing is sampled or filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _host(user_id: Column) -> Column:
    return (F.when(user_id < 20, F.lit("10.0.0.1"))
            .when(user_id % 3 == 0, F.concat(F.lit("host-"), user_id.cast("string"), F.lit(".example.com")))
            .otherwise(F.concat(F.lit("10.0.1."), user_id.cast("string"))))


def _status(event_id: Column, user_id: Column, event_type: Column) -> Column:
    return (F.when(event_id % 97 == 0, F.lit("-"))
            .when(user_id % 25 == 22, F.lit("403"))
            .when(event_type == "error", F.when(user_id % 2 == 0, F.lit("404")).otherwise(F.lit("500")))
            .when(event_type == "click", F.lit("302"))
            .otherwise(F.lit("200")))


def event_line(event_id: Column, ts: Column, user_id: Column, event_type: Column,
               value: Column, props: Column) -> Column:
    """The access-log line of one event, as a column expression."""
    method = F.when(event_type.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))
    url = F.concat(F.lit("/"), event_type, F.lit("/"), F.get_json_object(props, "$.k"))
    protocol = F.when(event_id % 53 == 0, F.lit("")).otherwise(F.lit(" HTTP/1.0"))
    size = F.when(event_id % 13 == 0, F.lit("-")).otherwise(F.floor(value * 100).cast("bigint").cast("string"))
    line = F.concat(
        _host(user_id), F.lit(" - - ["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        method, F.lit(" "), url, protocol, F.lit("\" "),
        _status(event_id, user_id, event_type), F.lit(" "), size)
    return F.when(event_id % 101 == 0, F.concat(F.lit("junk "), event_id.cast("string"))).otherwise(line)


#: Ranges of event ids that the lines are built in, whatever the cluster or the file.
FIXTURE_RANGES = 16


def spread(df: DataFrame, order_col: str) -> DataFrame:
    """The fixture's rows in FIXTURE_RANGES ranges of ``order_col``.

    The driver's tables are single files with one row group, which scan as one task.  Ranges
    (event ids rise with time) keep each task's rows contiguous in time, as splits of
    time-ordered log files are.  Only the fixture does this; log files are read as they are.
    """
    return df.repartitionByRange(FIXTURE_RANGES, order_col)


def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``value: string`` row per event, like ``spark.read.text`` gives."""
    ev = spread(read_table(spark, sf_dir, "events"), "event_id")
    return ev.select(event_line(F.col("event_id"), F.col("ts"), F.col("user_id"), F.col("event_type"),
                                F.col("value"), F.col("props")).alias("value"))
