"""Input files derived from the driver tables (written by Spark, in the
shared folder): a JSON-lines dump with absent / null / present keys, and
request files for the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlecorpus.sources.papers import papers_from_documents


def json_value(c: Column) -> Column:
    """JSON text of a string value (``null`` for NULL), escaped by to_json."""
    j = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return j.substr(F.lit(6), F.length(j) - 6)


def _member(key: str, value: Column, absent: Column, null: Column | None = None) -> Column:
    v = json_value(value) if null is None else F.when(null, F.lit("null")).otherwise(json_value(value))
    return F.when(~absent, F.concat(F.lit(f'"{key}":'), v))


def json_dump_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, value) JSON lines; key states chosen from ``doc_id``:

    title absent when id % 7 = 3, null when id % 11 = 5; abstract absent
    when id % 5 = 1 (null where the document has no body); journal-ref
    absent when id % 3 = 0, null when id % 3 = 1, else ``'J. <source>'``;
    categories absent when id % 13 = 7.
    """
    p = papers_from_documents(docs).join(docs.select(F.col("doc_id").alias("id"), "source"), "id")
    i = F.col("id")
    members = [
        _member("title", F.col("title"), i % 7 == 3, i % 11 == 5),
        _member("abstract", F.col("abstract"), i % 5 == 1),
        _member("journal-ref", F.concat(F.lit("J. "), F.col("source")), i % 3 == 0, i % 3 == 1),
        _member("categories", F.col("categories"), i % 13 == 7),
    ]
    return p.select(F.col("id").alias("doc_id"),
                    F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("value"))


def file_count(docs: DataFrame, at_least: int = 4) -> int:
    """One output file per input split (at least ``at_least``): the write
    runs as wide as the scan, whatever the data size."""
    return max(at_least, docs.rdd.getNumPartitions())


def write_json_dump(docs: DataFrame, path: str) -> str:
    """Write the dump as several text files whose names follow line order."""
    lines = json_dump_lines(docs)
    (lines.repartitionByRange(file_count(docs), "doc_id").sortWithinPartitions("doc_id")
     .select("value").write.mode("overwrite").text(path))
    return path


def write_requests(docs: DataFrame, path: str) -> int:
    """(id, abstract) request files; returns how many files were written."""
    reqs = papers_from_documents(docs).select("id", "abstract")
    n = file_count(docs)
    reqs.repartitionByRange(n, "id").write.mode("overwrite").parquet(path)
    return n
