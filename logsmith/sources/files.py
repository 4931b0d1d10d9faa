"""Small files of metadata through the Hadoop FileSystem API (local disk, HDFS, object stores)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(path, file system) as objects of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """Put a small text file at ``path`` in one step: readers see all of it or nothing.

    It is written under a hidden name first and renamed; ``path`` must be new.
    """
    target, fs = file_system(spark, path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    hidden, _ = file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:8]}")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(hidden, target):
        fs.delete(hidden, False)
        raise OSError(f"could not move a file to {path}")
    return path


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of the visible files in a folder and below, by name; none if it does not exist.

    A file has itself only, under the empty name.
    """
    root, fs = file_system(spark, folder)
    if not fs.exists(root):
        return []
    if fs.getFileStatus(root).isFile():
        return [("", fs.getFileStatus(root).getLen())]
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    found, walk = [], fs.listFiles(root, True)
    while walk.hasNext():
        status = walk.next()
        name = status.getPath().toString().removeprefix(base)
        if not any(part.startswith((".", "_")) for part in name.split("/")):
            found.append((name, status.getLen()))
    return sorted(found)


def make_folder(spark: SparkSession, folder: str) -> str:
    path, fs = file_system(spark, folder)
    fs.mkdirs(path)
    return folder
