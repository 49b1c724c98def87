"""WARC archives as a Spark data source, ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading: the plan has a partition per group of files (TARGET_BYTES together, a
larger file alone). Predicates on header columns (``record_type`` and every
other column but the payload) are pushed down and checked on the parsed header
of a record; the payload is decompressed only for records that pass, and only
if the schema asks for it: give ``.schema("record_id string")`` to read headers
alone. In ``.warc.gz`` files each record is a gzip member; those written here
name their length in the member's extra field ``sl``, so a reader steps over
what it does not want; members without it are inflated to their end.

Writing: one file per task, rolled at ROLL_BYTES, below ``_temporary`` until
the job commits, so attempts that fail or run twice leave nothing behind.

Paths: anything that pyarrow.fs opens (file, hdfs, s3, gs).

Defined results: a NULL payload is an empty one, a NULL header is left out and
NULL when read; line breaks in header values become %0D and %0A; a record
without a digest, length or date has NULLs there.
"""

from __future__ import annotations

import base64
import io
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull,
                                    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from titlecorpus.llm.common import hot_join, table
from titlecorpus.session import work_path

TARGET_BYTES, ROLL_BYTES, BATCH_BYTES, HEAD_BYTES = 64 << 20, 512 << 20, 8 << 20, 2048
#: Header names by column.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile", "content_type": "Content-Type"}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ", ".join([*(f"{c} string" for c in HEADERS), "payload_length long", "payload binary"])
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def files(path: str):
    """(file system, path in it) of a path as Spark writes it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def member(data: bytes, level: int = 1) -> bytes:
    """``data`` as a gzip member whose extra field ``sl`` holds the length of the member and of the data."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """One record; a payload goes into an HTTP response, a revisit has an empty block."""
    payload = row.get("payload") or b""
    block = b"" if row.get("record_type") == "revisit" else HTTP + payload
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = row.get(column)
        if column == "payload_digest" and value is not None:
            value = "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
        if column in ("record_id", "refers_to") and value is not None:
            value = f"<{value}>"
        if column == "content_type" and value is None:
            value = "application/http; msgtype=response"
        if value is not None:
            lines.append(f"{name}: {value}".replace("\r", "%0D").replace("\n", "%0A"))
    if row.get("payload_length") is not None:
        lines.append(f"X-Payload-Length: {row['payload_length']}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header(text: bytes) -> dict:
    """Columns of a header block; names in any case, values as they stand but for brackets and digests."""
    named = {}
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        named.setdefault(name.strip().lower(), value.strip())
    row = {c: named.get(h.lower()) for c, h in HEADERS.items()}
    for c in ("record_id", "refers_to"):
        if row[c] is not None:
            row[c] = row[c].removeprefix("<").removesuffix(">")
    digest = row["payload_digest"]
    if digest is not None:
        kind, _, value = digest.partition(":")
        row["payload_digest"] = base64.b32decode(value).hex() if kind.lower() == "sha1" and len(value) == 32 else value.lower()
    length = named.get("x-payload-length")
    row["payload_length"] = int(length) if length is not None else None
    row["_block"] = int(named.get("content-length", 0))
    return row


def payload_of(block: bytes, row: dict) -> bytes:
    if (row["content_type"] or "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def compressed(stream, wanted, with_payload: bool):
    """Rows of a ``.warc.gz``. ``wanted`` tells from a header whether the record is asked for."""
    at = 0
    while True:
        stream.seek(at)
        start = stream.read(24)
        if len(start) < 18:
            return
        if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
            length = struct.unpack("<I", start[16:20])[0]
            unpack, rest = zlib.decompressobj(-15), length - 32
            left, feed = rest, min(rest, HEAD_BYTES)
        else:
            length, unpack, left, feed = None, zlib.decompressobj(31), None, HEAD_BYTES
            stream.seek(at)
        text, used = b"", 0
        while b"\r\n\r\n" not in text and not unpack.eof:
            data = stream.read(feed if left is None else min(left, feed))
            if not data:
                break
            left = left if left is None else left - len(data)
            used += len(data)
            text += unpack.decompress(data)
        head, _, block = text.partition(b"\r\n\r\n")
        row = header(head)
        take = wanted(row)
        if take and with_payload and row["record_type"] != "revisit" or length is None:
            parts = [block]
            while not unpack.eof and (data := stream.read((1 << 20) if left is None else left)):
                left = left if left is None else left - len(data)
                used += len(data)
                parts.append(unpack.decompress(data))
            block = b"".join(parts)
        if take:
            yield row | ({"payload": payload_of(block[:row["_block"]], row)} if with_payload else {})
        at += length if length is not None else used - len(unpack.unused_data)


def plain(stream, wanted, with_payload: bool):
    """Rows of an uncompressed ``.warc``."""
    while line := stream.readline():
        if not line.strip():
            continue
        lines = [line.rstrip(b"\r\n")]
        while (line := stream.readline()).strip():
            lines.append(line.rstrip(b"\r\n"))
        row = header(b"\r\n".join(lines))
        if not wanted(row):
            stream.seek(row["_block"], io.SEEK_CUR)
        elif with_payload:
            yield row | {"payload": payload_of(stream.read(row["_block"]), row)}
        else:
            stream.seek(row["_block"], io.SEEK_CUR)
            yield row


#: Filter -> test of a header value that is not NULL.
TESTS = {
    EqualTo: lambda f: lambda v: v == f.value, In: lambda f: lambda v: v in f.value,
    StringStartsWith: lambda f: lambda v: v.startswith(f.value), StringEndsWith: lambda f: lambda v: v.endswith(f.value),
    StringContains: lambda f: lambda v: f.value in v, IsNotNull: lambda f: lambda v: True,
}


@dataclass
class Files(InputPartition):
    paths: list


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.columns, self.filters = path, schema.names, []

    def pushFilters(self, filters):
        """Keeps what a header decides; gives the rest back to Spark."""
        for f in filters:
            known = isinstance(f, (*TESTS, IsNull)) and len(f.attribute) == 1 and f.attribute[0] in (*HEADERS, "payload_length")
            if known and (f.attribute[0] != "payload_length" or isinstance(f, (EqualTo, In, IsNull, IsNotNull))):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, path = files(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=False)) if system.get_file_info(path).type == fs.FileType.Directory else [system.get_file_info(path)]
        groups, size = [[]], 0
        for f in sorted((f for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))), key=lambda f: f.path):
            if groups[-1] and size + f.size > TARGET_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(f.path)
            size += f.size
        return [Files(g) for g in groups]

    def read(self, partition):
        import pyarrow as pa

        tests = [(f.attribute[0], None if isinstance(f, IsNull) else TESTS[type(f)](f)) for f in self.filters]
        wanted = lambda row: all((row[c] is None) if t is None else row[c] is not None and t(row[c]) for c, t in tests)
        types = {"payload": pa.binary(), "payload_length": pa.int64()}
        schema = pa.schema([(c, types.get(c, pa.string())) for c in self.columns])
        rows, size = [], 0
        batch = lambda: pa.RecordBatch.from_pylist([{c: r.get(c) for c in self.columns} for r in rows], schema)
        system = files(self.path)[0]
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                stream = io.BufferedReader(raw, 1 << 20)
                for row in (compressed if path.endswith(".gz") else plain)(stream, wanted, "payload" in self.columns):
                    rows.append(row)
                    size += 500 + len(row.get("payload") or b"")
                    if size > BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator):
        system, path = files(self.path)
        work = f"{path}/_temporary/{self.job}"
        system.create_dir(work, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size > ROLL_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{work}/{names[-1]}", compression=None), 0
                    data = member(record(row))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages):
        from pyarrow import fs

        system, path = files(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if f.is_file and f.base_name.endswith((".warc", ".warc.gz")):
                    system.delete_file(f.path)
        system.create_dir(path, recursive=True)
        for message in messages:
            for name in message.names if message else []:
                system.move(f"{path}/_temporary/{self.job}/{name}", f"{path}/{name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        system, path = files(self.path)
        work = f"{path}/_temporary/{self.job}"
        if system.get_file_info(work).type == fs.FileType.Directory:
            system.delete_dir(work)
        others = fs.FileSelector(f"{path}/_temporary", allow_not_found=True)
        if system.get_file_info(others.base_dir).type == fs.FileType.Directory and not system.get_file_info(others):
            system.delete_dir(others.base_dir)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to this session and let its filters be pushed down."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(rows: DataFrame, key: str, least: int = 1000) -> DataFrame:
    """``rows`` (with ``payload``) plus payload_digest, payload_length and ``leader``.

    Of equal payloads of at least ``least`` bytes, ``leader`` is the largest
    key; it is NULL where no other row has the payload or it is shorter.
    """
    sized = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    sized = sized.withColumn("equal", F.when(F.col("payload_length") >= least, F.col("payload_digest")))
    groups = sized.where("equal is not null").groupBy("equal").agg(F.max(key).alias("leader"), F.count("*").alias("held")).where("held > 1")
    return hot_join(sized, groups, "equal", "held").drop("equal")


def write_pages(pages: DataFrame, path: str) -> None:
    """Archive ``pages`` (page_id, url, html) at ``path``; repeated payloads become revisits of the page with the largest id."""
    register(pages.sparkSession)
    rows = with_revisits(pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")), "page_id")
    revisit = F.col("leader") != F.col("page_id")
    name = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"),
        F.lit("1970-01-01T00:00:00Z").alias("date"), F.col("url").alias("target_uri"), "payload_digest",
        F.when(revisit, name("leader")).alias("refers_to"), F.when(revisit, IDENTICAL).alias("profile"),
        F.lit(None).cast("string").alias("content_type"), "payload_length", F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Digest rows of an archive: responses from their payloads, revisits from their headers alone."""
    register(spark)
    read = lambda columns, kind: spark.read.format("warc").schema(columns).load(path).where(F.col("record_type") == kind)
    page = lambda c: F.substring_index(c, ":", -1).cast("long")
    full = read("record_id string, record_type string, payload binary", "response").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = read("record_id string, record_type string, refers_to string, payload_digest string, payload_length long", "revisit").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"))
    return full.unionByName(again)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "pages_warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    return read_pages(spark, path)


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS leader FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN leader <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN leader <> page_id THEN leader END AS refers_to
FROM l
"""
