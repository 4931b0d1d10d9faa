"""Runs that appear in one step (S6, S7): attempt folders and a manifest per run.

A run writes each of its tables into a folder of its own attempt; nobody reads there yet.  When
all tables are written, one manifest that names every file with its size, and every table with
its rows, is put in place by a rename.  Readers follow the newest manifest of a run, so a run
that died, still writes or is written again never shows half its tables; the one before stays.

::

    base/attempts/<run_id>.<attempt>/<table>/part-*     the tables, written once, never changed
    base/manifests/<run_id>.<attempt>.json              a row per file

An attempt's number is the time it was begun at, so a later attempt of a run replaces an earlier
one, whatever order they end in.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsmith.sources.files import list_files, write_text

MANIFEST_SCHEMA = ("run_id string, attempt string, committed_at double, table string, format string, schema string, "
                   "path string, file string, bytes long, row_count long")


class Run:
    """One attempt at a run.  Use as a context manager: it commits when the block ends well.

    An exception inside leaves the manifest unwritten: the attempt's files stay unread.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str):
        if not run_id or set(run_id) & set("/.\\"):
            raise ValueError(f"not a run id: {run_id!r}")
        self.spark, self.base, self.run_id = spark, base.rstrip("/"), run_id
        self.attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.folder = f"{self.base}/attempts/{run_id}.{self.attempt}"
        self._entries: list[dict] = []
        self.committed = False

    def write(self, table: str, df: DataFrame, fmt: str = "parquet", **options) -> str:
        """Write a table of this run; its rows are counted by the same job."""
        self._must_be_new(table, fmt)
        path, seen = self.path(table), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**options).save(path)
        self.add(table, path, fmt, seen.get["n"], df.schema.json())
        return path

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def add(self, table: str, path: str, fmt: str, row_count: int | None = None, schema: str | None = None) -> None:
        """Name a table (in one format) that was written into the attempt's folder."""
        self._must_be_new(table, fmt)
        self._entries.append({"table": table, "format": fmt, "schema": schema, "row_count": row_count,
                              "path": path.removeprefix(self.folder + "/"), "files": list_files(self.spark, path)})

    def _must_be_new(self, table: str, fmt: str) -> None:
        if any((e["table"], e["format"]) == (table, fmt) for e in self._entries):
            raise ValueError(f"the run has the table {table} as {fmt} already")

    def commit(self) -> str:
        """Put the manifest in place; from here on readers see this run."""
        if self.committed:
            raise RuntimeError("the run is committed already")
        now, rows = time.time(), []
        for e in self._entries:
            for name, size in e["files"] or [(None, 0)]:
                rows.append({"run_id": self.run_id, "attempt": self.attempt, "committed_at": now, "table": e["table"],
                             "format": e["format"], "schema": e["schema"], "path": e["path"], "file": name,
                             "bytes": size, "row_count": e["row_count"]})
        rows = rows or [{"run_id": self.run_id, "attempt": self.attempt, "committed_at": now}]
        path = write_text(self.spark, f"{self.base}/manifests/{self.run_id}.{self.attempt}.json",
                          "".join(json.dumps(r) + "\n" for r in rows))
        self.committed = True
        return path

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None and not self.committed:
            self.commit()


def _newest(spark: SparkSession, base: str) -> dict[str, str]:
    """Manifest file of the newest committed attempt of each run, by listing names only."""
    newest: dict[str, str] = {}
    for name, _ in list_files(spark, f"{base.rstrip('/')}/manifests"):
        run_id, attempt, suffix = name.rsplit(".", 2)
        if suffix == "json":
            newest[run_id] = max(newest.get(run_id, ""), name)
    return newest


def run_ids(spark: SparkSession, base: str) -> list[str]:
    """Ids of the committed runs under ``base``, in order."""
    return sorted(_newest(spark, base))


def manifest_files(spark: SparkSession, base: str) -> DataFrame:
    """A row per file of the newest attempt of every committed run (``MANIFEST_SCHEMA``)."""
    base = base.rstrip("/")
    names = [f"{base}/manifests/{name}" for name in _newest(spark, base).values()]
    if not names:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(names)


def manifest_tables(spark: SparkSession, base: str) -> DataFrame:
    """A row per table of every committed run: run_id, table, format, row_count, n_files, bytes."""
    return (manifest_files(spark, base).where("table IS NOT NULL").groupBy("run_id", "table", "format")
            .agg(F.max("row_count").alias("row_count"), F.count("file").alias("n_files"), F.sum("bytes").alias("bytes")))


def read_run(spark: SparkSession, base: str, table: str, run_id: str | None = None, fmt: str = "parquet",
             **options) -> DataFrame:
    """A table of a committed run (default: of the newest), read from exactly the files its manifest names.

    Fails if the run or table is not there or if a named file is missing or has another size.
    """
    newest = _newest(spark, base)
    if not newest or (run_id is not None and run_id not in newest):
        raise LookupError(f"no committed run {run_id or ''} under {base}")
    return _read(spark, base, [newest[run_id if run_id is not None else max(newest)]], table, fmt, options)


def read_all_runs(spark: SparkSession, base: str, table: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of every committed run that has it, with a column run_id; the runs' schemas are equal."""
    names = sorted(_newest(spark, base).values())
    if not names:
        raise LookupError(f"no committed run under {base}")
    rows = _read(spark, base, names, table, fmt, options)
    attempt = F.regexp_extract(F.col("_metadata.file_path"), r"/attempts/([^/.]+)\.[^/]*/", 1)
    return rows.select("*", attempt.alias("run_id"))


def _read(spark: SparkSession, base: str, names: list[str], table: str, fmt: str, options: dict) -> DataFrame:
    base = base.rstrip("/")
    # the files of one table, which the driver lists for any read
    entries = (spark.read.schema(MANIFEST_SCHEMA).json([f"{base}/manifests/{n}" for n in names])
               .where((F.col("table") == table) & (F.col("format") == fmt)).collect())
    if not entries:
        raise LookupError(f"{names[-1]} and the runs beside it have no table {table} as {fmt}")
    there: dict[str, int] = {}
    wanted: dict[str, int] = {}
    for folder in {f"{base}/attempts/{e.run_id}.{e.attempt}/{e.path}" for e in entries}:
        there |= {f"{folder}/{name}".rstrip("/"): size for name, size in list_files(spark, folder)}
    for e in entries:
        if e.file is not None:
            wanted[f"{base}/attempts/{e.run_id}.{e.attempt}/{e.path}/{e.file}".rstrip("/")] = e.bytes
    lost = sorted(f for f, size in wanted.items() if there.get(f) != size)
    if lost:
        raise OSError(f"{len(lost)} files of {table} are lost or changed, {lost[0]} first")
    reader = spark.read.format(fmt).options(**options)
    if entries[-1].schema:
        reader = reader.schema(StructType.fromJson(json.loads(entries[-1].schema)))
    return reader.load(sorted(wanted))


def unread_attempts(spark: SparkSession, base: str, older_than_seconds: float = 86_400.0) -> list[str]:
    """Attempt folders that no newest manifest names, begun long ago: they may be deleted."""
    base = base.rstrip("/")
    kept = {name.removesuffix(".json") for name in _newest(spark, base).values()}
    begun = time.time_ns() - int(older_than_seconds * 1e9)
    names = {name.split("/", 1)[0] for name, _ in list_files(spark, f"{base}/attempts")}
    return sorted(n for n in names - kept if int(n.rsplit(".", 1)[1].split("-")[0]) < begun)
