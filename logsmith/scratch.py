"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsmith.session import scratch_path
from logsmith.sources.files import file_system

#: Scratch tables that this driver wrote and has not dropped: (application, path).
_tables: list[tuple[str, str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage with a copy that survives a lost executor, lets later reads prune columns,
    and gives joins plain scans on both sides, so that adaptive execution can split a hot key.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _tables.append((df.sparkSession.sparkContext.applicationId, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """The place in the list of scratch tables from which on those stored later stand."""
    return len(_tables)


def drop_scratch(spark: SparkSession, *keep: DataFrame, since: int = 0) -> int:
    """Delete this application's scratch tables but those that ``keep`` reads; returns how many.
    With ``since`` (a ``scratch_mark``) only tables stored after it are deleted.

    For the caller who is done with every result so far that was not written elsewhere, as at
    the start of a job's next stage.  If ``keep`` reads anything but files (a cached table may
    still have to be computed), nothing is deleted.  Unread shuffle files go once the driver
    forgets them.
    """
    for df in keep:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        if any(leaves.apply(i).getClass().getSimpleName() != "LogicalRelation" for i in range(leaves.size())):
            return 0
    app = spark.sparkContext.applicationId
    used = " ".join(file for df in keep for file in df.inputFiles())
    dropped = 0
    for entry in [t for t in _tables[since:] if t[0] == app and t[1].rsplit("/", 1)[1] not in used]:
        path, fs = file_system(spark, entry[1])
        fs.delete(path, True)
        _tables.remove(entry)
        dropped += 1
    spark.sparkContext._jvm.System.gc()
    return dropped
