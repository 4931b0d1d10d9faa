"""Text sources and sinks for raw log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_log_text(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """A file, a directory or a glob of log files -> ``value: string``.

    Splittable plain-text files are cut into ``spark.sql.files.maxPartitionBytes``
    pieces, so one large log file is read by many tasks.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def read_log_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = 1,
                    latest_first: bool = False) -> DataFrame:
    """Watch a directory; each micro-batch takes at most ``max_files_per_trigger`` new files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if latest_first:
        reader = reader.option("latestFirst", "true")
    return reader.load(source_dir)


def write_log_text(lines: DataFrame, path: str, mode: str = "overwrite",
                   partition_by: list[str] | None = None) -> None:
    """Write ``value`` lines as plain text (one part file per task)."""
    writer = lines.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)
