"""The parsed ``logs`` table persisted as Parquet, partitioned by day.

At scale the raw text is parsed once; every KPI, feature and graph job then
reads this table, so a filter on ``date`` prunes whole directories and
filters on ``status`` / ``ip`` / ``timestamp`` reach the Parquet reader
(row-group statistics), and only the referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logsmith.operators.parsing import LOG_COLUMNS, parse_logs


def write_logs_table(logs: DataFrame, path: str, mode: str = "overwrite", cluster: bool = False,
                     max_records_per_file: int = 5_000_000) -> str:
    """Write parsed logs partitioned by ``date``, ``timestamp`` stored as a UTC instant.

    By default each parse task writes its own rows straight out (no shuffle):
    log files are written in time order, so a task's input spans few days.
    ``cluster=True`` range-partitions on (date, timestamp) first, for inputs
    whose files mix many days; range boundaries are sampled, so a day holding a
    third of all rows is cut over many tasks rather than sent to one.
    Files are capped at ``max_records_per_file`` rows.
    """
    if cluster:
        logs = logs.repartitionByRange("date", "timestamp")
    (logs.sortWithinPartitions("date")
     .write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("date")
     .parquet(path))
    return path


LOGS_SCHEMA = ("ip string, timestamp timestamp, method string, url string, protocol string, status int, "
               "bytes bigint, hour int, day_of_week int, date string, is_error int, status_category string")


def read_logs_table(spark: SparkSession, path: str) -> DataFrame:
    """Read the table back with the column order and types of ``parse_logs``.

    The schema is given, so no footer is read for inference and the ``date``
    partition column stays a string (inference would make it a DATE).
    """
    return spark.read.schema(LOGS_SCHEMA).parquet(path).select(*[F.col(c) for c in LOG_COLUMNS])


def parse_and_store(lines: DataFrame, path: str, cluster: bool = False) -> DataFrame:
    """Parse raw lines once into the logs table and return the reject counts.

    Line and accepted-row counts are observed metrics of the same job that
    writes the table (``DataFrame.observe``), so the raw text is read exactly
    once; the returned ``(accepted, line_count)`` table is built from those two
    numbers.
    """
    seen, kept = Observation("lines"), Observation("accepted")
    logs = parse_logs(lines.observe(seen, F.count(F.lit(1)).alias("n")))
    write_logs_table(logs.observe(kept, F.count(F.lit(1)).alias("n")), path, cluster=cluster)
    total, accepted = int(seen.get["n"]), int(kept.get["n"])
    return lines.sparkSession.createDataFrame(
        [(True, accepted), (False, total - accepted)], "accepted boolean, line_count long")
