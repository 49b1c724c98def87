"""Folders whose state is named by their newest manifest.

A writer puts new files under fresh names and, last of all, publishes a small
manifest that lists what belongs to the new state: written aside and renamed,
so it is there whole or not at all. Readers open what the newest manifest
names. A writer that dies before the rename leaves the state as it was; its
files are named by nothing. One writer at a time; a second one that publishes
the same version is told so.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifests"


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` (any that Spark reads), and the folder of its manifests."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, FOLDER)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _name(version: int) -> str:
    return f"v{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """All published versions, rising."""
    fs, folder = _files(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def load(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict | None]:
    """(version, content) of a version, or of the newest one; (0, None) where nothing was published."""
    if version is None:
        version = max(versions(spark, path), default=0)
    if not version:
        return 0, None
    fs, folder = _files(spark, path)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, _name(version)))
    try:
        return version, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, content: dict, after: int) -> int:
    """Make ``content`` the version that follows ``after``; raises if another writer has published one since."""
    fs, folder = _files(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path
    final, aside = new(folder, _name(after + 1)), new(folder, f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise RuntimeError(f"version {after + 1} of {path} was published by another writer")
    return after + 1
