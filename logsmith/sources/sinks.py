"""Batch sinks and exports.

* Parquet / JSON lines / CSV writers, overwrite by default.
* A single-file CSV export (``coalesce(1)``) for tables that the caller knows to
  be small by construction (a top-k, a status table); everything else is a
  directory, at any size.  The part file is renamed through the Hadoop
  FileSystem API, so it works on HDFS / object stores as well as on local disk.
* CSV tells NULL (``\\N``) from the empty string on both sides.
* Versioned exports are runs (``sources/runs.py``): written aside, seen once complete;
  earlier ones stay instead of being moved to an archive folder.
* A bundle export materialises each table once (Parquet), then writes JSON
  and CSV from that copy (sorted for presentation), and reports each write's
  outcome as a row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logsmith.sources.files import file_system
from logsmith.sources.runs import Run, read_run, run_ids

CSV_OPTIONS = {"header": "true", "nullValue": "\\N"}   # empty strings are written as ""


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """S3."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, one part file per task."""
    df.write.mode(mode).json(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back what ``write_csv`` or ``write_single_csv`` wrote."""
    return spark.read.options(emptyValue="", **CSV_OPTIONS).schema(schema).csv(path)


def write_single_csv(df: DataFrame, out_file: str) -> str:
    """One CSV file with a header at ``out_file``, written by one task.

    For tables bounded by construction: calling it says that ``df`` is one.  An existing file
    is replaced only once the new one is complete.
    """
    spark = df.sparkSession
    tmp = out_file.rstrip("/") + "._tmp"
    df.coalesce(1).write.mode("overwrite").options(**CSV_OPTIONS).csv(tmp)
    tmp_path, fs = file_system(spark, tmp)
    parts = [s.getPath() for s in fs.listStatus(tmp_path) if s.getPath().getName().startswith("part-")]
    target, _ = file_system(spark, out_file)
    if fs.exists(target):
        fs.delete(target, True)
    if not parts or not fs.rename(parts[0], target):
        raise OSError(f"could not move the file under {tmp} to {out_file}; the data is still there")
    fs.delete(tmp_path, True)
    return out_file


read_single_csv = read_csv


def new_run_id() -> str:
    """Run id in the archive naming of the reference: UTC ``YYYYmmdd_HHMMSS``."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


#: Name of the one table of a run that ``write_version`` makes.
VERSION_TABLE = "data"


def write_version(df: DataFrame, base: str, run_id: str | None = None, fmt: str = "parquet") -> str:
    """Write ``df`` as a run of ``base`` (default id: now).

    A retry under the same id replaces the run in one step once it is complete.
    """
    with Run(df.sparkSession, base, run_id or new_run_id()) as run:
        run.write(VERSION_TABLE, df, fmt)
    return base


def latest_version(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the newest complete run with its ``run_id``; no other run's files are read."""
    newest = run_ids(spark, base)[-1:]
    rows = read_run(spark, base, VERSION_TABLE, newest[0] if newest else None, fmt)
    return rows.select("*", F.lit(newest[0]).alias("run_id"))


def sort_columns(spec: list[str]) -> list:
    """``["-count", "url"]`` -> ``[desc(count), asc(url)]``."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in spec]


@dataclass(frozen=True)
class ExportResult:
    name: str
    format: str
    ok: bool
    error: str
    path: str


BUNDLE_SCHEMA = "name string, format string, ok boolean, error string, path string"


def export_bundle(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
                  formats: tuple[str, ...] = ("parquet", "json", "csv"),
                  order: dict | None = None, single_file: frozenset[str] = frozenset(),
                  run: Run | None = None) -> DataFrame:
    """Every table to Parquet, JSON and CSV; one failure does not stop the rest.

    Each table is computed once: written to Parquet first, and the JSON and CSV copies are
    written from that Parquet copy.  ``order`` maps a table name to column names (``-name``
    for descending) for the copies.  Copies are directories, range-sorted across the cluster;
    ``single_file`` names tables bounded by construction, whose CSV is one file.  With a
    ``run`` everything goes into its attempt folder and every write that succeeds into its
    manifest; the caller commits it (``out_dir`` is then not used).  Returns one status row per
    write, also for copies that were not tried because the table failed.
    """
    order = order or {}
    out_dir = run.folder if run else out_dir.rstrip("/")
    results: list[ExportResult] = []
    for name, df in tables.items():
        pq = f"{out_dir}/parquet/{name}"
        seen = Observation()
        try:
            write_parquet(df.observe(seen, F.count(F.lit(1)).alias("n")), pq)
            if run:
                run.add(name, pq, "parquet", seen.get["n"], df.schema.json())
            results.append(ExportResult(name, "parquet", True, "", pq))
        except Exception as e:  # noqa: BLE001 - reported as a status row
            results += [ExportResult(name, f, False, str(e)[:500], pq if f == "parquet" else f"{out_dir}/{f}/{name}.{f}")
                        for f in ("parquet", *(f for f in formats if f != "parquet"))]
            continue
        saved = spark.read.parquet(pq)
        sort = sort_columns(order[name]) if name in order else None
        if name in single_file:
            saved = saved.coalesce(1)
            saved = saved.sortWithinPartitions(*sort) if sort else saved
        elif sort:
            saved = saved.orderBy(*sort)
        for fmt in formats:
            if fmt == "parquet":
                continue
            path = f"{out_dir}/{fmt}/{name}.{fmt}"
            try:
                if fmt == "json":
                    write_json(saved, path)
                elif fmt == "csv":
                    (write_single_csv if name in single_file else write_csv)(saved, path)
                else:
                    raise ValueError(f"unknown format {fmt}")
                if run:
                    run.add(name, path, fmt, seen.get["n"], df.schema.json())
                results.append(ExportResult(name, fmt, True, "", path))
            except Exception as e:  # noqa: BLE001
                results.append(ExportResult(name, fmt, False, str(e)[:500], path))
    return spark.createDataFrame([(r.name, r.format, r.ok, r.error, r.path) for r in results], BUNDLE_SCHEMA)


def export_graph(vertices: DataFrame, edges: DataFrame, out_dir: str) -> tuple[str, str]:
    """Vertices and edges as CSV directories with a header."""
    v, e = f"{out_dir.rstrip('/')}/graph_vertices", f"{out_dir.rstrip('/')}/graph_edges"
    write_csv(vertices, v)
    write_csv(edges, e)
    return v, e
