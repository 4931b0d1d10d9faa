"""Incremental ingestion: new log files are parsed once and added to the logs table.

A file stream remembers in its checkpoint which files it has read; ``availableNow`` takes what is
new and stops, so a scheduled job costs what has come since the last one.  Each micro-batch
replaces its own partitions ``date=*/ingest=<feed>-<batch>`` of the table (dynamic overwrite): a
batch that is repeated after a failure adds no row twice.  ``read_logs_table`` reads the result
like any other logs table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsmith.operators.parsing import parse_logs
from logsmith.sources.files import list_files, write_text
from logsmith.sources.text import read_log_stream
from logsmith.streaming.stream import run_to_completion

COUNTS_SCHEMA = "ingest string, line_count long, accepted long"


def add_batch(lines: DataFrame, table_path: str, ingest: str, max_records_per_file: int = 5_000_000) -> None:
    """Parse raw lines into the partitions of one ingest; the same ingest again replaces them.

    Line and accepted counts are observed by the job that writes, and put beside the table.
    """
    seen, kept = Observation(), Observation()
    logs = parse_logs(lines.observe(seen, F.count(F.lit(1)).alias("n")))
    (logs.observe(kept, F.count(F.lit(1)).alias("n")).withColumn("ingest", F.lit(ingest)).sortWithinPartitions("date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("date", "ingest").parquet(table_path))
    counts = counts_path(table_path)
    if f"{ingest}.json" not in dict(list_files(lines.sparkSession, counts)):
        write_text(lines.sparkSession, f"{counts}/{ingest}.json", json.dumps(
            {"ingest": ingest, "line_count": seen.get["n"], "accepted": kept.get["n"]}) + "\n")


def counts_path(table_path: str) -> str:
    """Where the counts of the ingests of a table are."""
    return table_path.rstrip("/") + "-ingests"


def ingest_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """A row per ingest: its lines and how many of them were accepted."""
    return spark.read.schema(COUNTS_SCHEMA).json(counts_path(table_path))


def ingest_new_files(spark: SparkSession, source_dir: str, table_path: str, checkpoint_dir: str, feed: str = "feed",
                     max_files_per_batch: int | None = None) -> StreamingQuery:
    """Add the files that have come to ``source_dir`` since the last call to the logs table.

    ``feed`` names the source; each needs a checkpoint of its own.  Returns the finished query.
    ``max_files_per_batch`` bounds a batch after a long pause, so that a failure repeats little.
    """
    if not feed or set(feed) & set("/=-"):
        raise ValueError(f"not a feed name: {feed!r}")
    query = (read_log_stream(spark, source_dir, max_files_per_batch).writeStream
             .foreachBatch(lambda lines, no: add_batch(lines, table_path, f"{feed}-{no:09d}"))
             .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{feed}").trigger(availableNow=True).start())
    return run_to_completion(query)
