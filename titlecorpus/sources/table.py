"""The papers table: create-if-absent, append with generated ids, scans.

The table is a folder of Parquet segments, one an append, named by a manifest
(``manifest``). Appends number the new rows after the current last id in the
order of the input (single writer assumed, as with an autoincrement key); a
second append of the same rows stores them again under new ids.

A segment comes with a position index, a small Parquet table with the first
id, the last id and the rows of each of its files. An append by an order key
writes the text once, sorted over its files, and needs no id column: a row's id
is its file's first id plus its place in the file. An append of rows that carry
their position stores the id. The index tells which files hold the first N rows
or record k, so those scans open no other file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titlecorpus.operators.select import first_n, row_at
from titlecorpus.schema import (DISPLAY_HEADING, DISPLAY_LABELS, DISPLAY_SEPARATOR, PAPER_SCHEMA,
                                TEXT_FIELDS)
from titlecorpus.sources import manifest

#: Files whose index rows (16 bytes each) are broadcast, and files that are named in the plan itself.
BROADCAST_FILES, NAMED_FILES = 5_000_000, 1000
_TEXT_SCHEMA = StructType([f for f in PAPER_SCHEMA.fields if f.name in TEXT_FIELDS])


def create_table(spark: SparkSession, path: str) -> None:
    """Create the empty table if it is not there (idempotent)."""
    if not manifest.versions(spark, path):
        manifest.publish(spark, path, {"segments": []}, 0)


def _segments(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    version, state = manifest.load(spark, path)
    if state is None:
        raise FileNotFoundError(f"{path} holds no papers table")
    return version, state["segments"]


def _index(spark: SparkSession, path: str, segments: list[dict]) -> DataFrame:
    """(file, first, last, n) of the segments' files."""
    return spark.read.schema("file string, first long, last long, n long").parquet(*(f"{path}/{s['index']}" for s in segments))


def _placed(files: DataFrame, first: DataFrame | list) -> DataFrame:
    """Papers of position files: the id is the file's first id plus the row's place in the file."""
    name, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    if isinstance(first, list):
        known = F.create_map(*(F.lit(x) for pair in first for x in pair))
        return files.select((known[name] + place).alias("id"), *TEXT_FIELDS)
    named = files.select(F.xxhash64(name).alias("_file"), place.alias("_place"), *TEXT_FIELDS)
    return named.join(first.select(F.xxhash64("file").alias("_file"), "first"), "_file").select((F.col("first") + F.col("_place")).alias("id"), *TEXT_FIELDS)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The papers table with its fixed schema."""
    _, segments = _segments(spark, path)
    out = None
    for kind in ("column", "position"):
        some = [s for s in segments if s["ids"] == kind]
        if not some:
            continue
        folders = [f"{path}/{s['folder']}" for s in some]
        if kind == "column":
            part = spark.read.schema(PAPER_SCHEMA).parquet(*folders)
        else:
            index = _index(spark, path, some)
            small = sum(s["files"] for s in some) <= BROADCAST_FILES
            part = _placed(spark.read.schema(_TEXT_SCHEMA).parquet(*folders), F.broadcast(index) if small else index)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], PAPER_SCHEMA) if out is None else out


def append_papers(spark: SparkSession, path: str, papers: DataFrame, order_cols=None,
                  rank_col: str | None = None) -> int:
    """Append ``papers`` (the four text fields) under ids last+1..

    The new ids follow ``rank_col`` when the input already carries a dense
    1..n position (no shuffle), else ``order_cols``: the rows are range-sorted
    into the new files once, and their places are their ids. Rows and index
    are written under fresh names; the manifest, published last, makes them
    part of the table. Returns the number of rows written.
    """
    create_table(spark, path)
    version, segments = _segments(spark, path)
    start = max((s["last"] for s in segments), default=0)
    name = uuid.uuid4().hex
    folder, index = f"data-{name}", f"index-{name}"
    if rank_col is None:
        cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
        parts = max(spark.sparkContext.defaultParallelism, papers.rdd.getNumPartitions())
        papers.repartitionByRange(parts, *cols).sortWithinPartitions(*cols).select(*TEXT_FIELDS).write.parquet(f"{path}/{folder}")
        written = spark.read.schema(_TEXT_SCHEMA).parquet(f"{path}/{folder}")
        files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
        # Files are named by partition, in the order of the keys; one row a file meets here.
        part = F.regexp_extract("file", r"^part-(\d+)-", 1).cast("long")
        last = F.sum("n").over(Window.orderBy(part, "file")) + F.lit(start)
        files = files.withColumn("last", last).select("file", (F.col("last") - F.col("n") + 1).alias("first"), "last", "n")
    else:
        papers.select((F.col(rank_col) + F.lit(start)).cast("long").alias("id"), *TEXT_FIELDS).write.parquet(f"{path}/{folder}")
        written = spark.read.schema(PAPER_SCHEMA).parquet(f"{path}/{folder}")
        files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    files.coalesce(1).write.parquet(f"{path}/{index}")
    held = _index(spark, path, [{"index": index}]).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")).first()
    if not held["n"]:
        return 0
    segment = {"folder": folder, "index": index, "ids": "position" if rank_col is None else "column", **held.asDict()}
    manifest.publish(spark, path, {"segments": [*segments, segment]}, version)
    return int(held["n"])


def _between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The rows with ids from ``low`` to ``high``, of the files that hold such ids."""
    _, segments = _segments(spark, path)
    out = None
    for s in segments:
        if s["first"] > high or s["last"] < low:
            continue
        files = _index(spark, path, [s]).where((F.col("first") <= high) & (F.col("last") >= low))
        # No more names reach the driver than the plan takes; a wider range reads the segment and its index.
        some = [(r["file"], r["first"]) for r in files.select("file", "first").limit(NAMED_FILES + 1).collect()]
        whole = len(some) > NAMED_FILES
        paths = [f"{path}/{s['folder']}"] if whole else [f"{path}/{s['folder']}/{f}" for f, _ in some]
        if s["ids"] == "column":
            part = spark.read.schema(PAPER_SCHEMA).parquet(*paths)
        else:
            part = _placed(spark.read.schema(_TEXT_SCHEMA).parquet(*paths), F.broadcast(files) if whole and s["files"] <= BROADCAST_FILES else files if whole else some)
        part = part.where(F.col("id").between(low, high))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], PAPER_SCHEMA) if out is None else out


def _dense(segments: list[dict]) -> bool:
    """Whether the ids of the table are 1, 2, 3 ... without a gap."""
    ends = [0, *(s["last"] for s in segments)]
    return all(s["first"] == e + 1 and s["last"] - s["first"] + 1 == s["n"] for s, e in zip(segments, ends))


def first_papers(spark: SparkSession, path: str, limit: int | None = 10) -> DataFrame:
    """All columns of the first ``limit`` rows by id (``None`` or negative: all), read from the files that hold them."""
    _, segments = _segments(spark, path)
    if limit is None or limit < 0 or not _dense(segments):
        return fetch_papers(read_table(spark, path), limit)
    return _between(spark, path, 1, limit)


def paper_by_position(spark: SparkSession, path: str, index: int) -> DataFrame:
    """The paper at 0-based position ``index`` in id order (0 or 1 row), read from the file that holds it."""
    if index < 0:
        raise IndexError("index must be >= 0")
    _, segments = _segments(spark, path)
    return _between(spark, path, index + 1, index + 1) if _dense(segments) else paper_at(read_table(spark, path), index)


def fetch_papers(table: DataFrame, limit: int | None = 10) -> DataFrame:
    """All columns of the first ``limit`` rows by id (``None`` or negative: all)."""
    return first_n(table, ["id"], None if limit is None or limit < 0 else limit)


def fetch_papers_for_training(table: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, abstract, title) of all rows, or the first ``limit`` by id."""
    return fetch_papers(table.select("id", "abstract", "title"), limit)


def paper_at(table: DataFrame, index: int) -> DataFrame:
    """The paper at 0-based position ``index`` in id order (0 or 1 row)."""
    return row_at(table, "id", index)


def format_paper(row: Row, index: int) -> str:
    """Display text of one record at 0-based position ``index``."""
    lines = [DISPLAY_HEADING.format(number=index + 1)]
    lines += [f"{label}: {row[name]}" for name, label in DISPLAY_LABELS]
    return "\n".join(lines + [DISPLAY_SEPARATOR])


def paper_info(table: DataFrame, index: int) -> str:
    """Display text of the record at 0-based ``index``; past the end raises."""
    row = paper_at(table, index).first()
    if row is None:
        raise IndexError(f"no paper at position {index}")
    return format_paper(row, index)


def show_papers(table: DataFrame, k: int) -> str:
    """Text of the first ``k`` papers; raises when there are fewer."""
    rows = fetch_papers(table, k).orderBy("id").collect()
    if len(rows) < k:
        raise IndexError(f"only {len(rows)} papers, asked for {k}")
    return "\n".join(format_paper(r, i) for i, r in enumerate(rows))
