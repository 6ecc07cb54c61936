"""WARC archives: a PySpark Python data source (format ``warc``) and the
archiving of a page table.

Reading plans one partition per archive file.  Filters on the record type, the
header columns and the record id are pushed down: a task parses the header
block of each record first and steps over the payload of a record that no
filter keeps (or of all, with option ``payload=false``) without reading it.
Payloads are gzip-encoded bodies, which only wanted records inflate; digests and
lengths are of the full payload.  ``.warc.gz`` files of one gzip member per
record are read too.

Writing makes files of about ``fileBytes`` per task under unique temporary
names; they appear under the final names only when the whole job commits, so
repeated or speculative tasks leave no part of an archive.

Paths are opened through ``pyarrow.fs`` by their scheme (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import gzip
import hashlib
import io
import posixpath
import uuid
from dataclasses import dataclass
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    IsNotNull, WriterCommitMessage)

from .common import only, scratch

SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, "
          "refers_to string, content_length long, payload binary")
# column -> header; fixed names of the WARC 1.1 format, but for the payload's full length
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "payload_bytes": "x-payload-length",
    "refers_to": "warc-refers-to",
    "content_length": "content-length",
}
_INTS = ("payload_bytes", "content_length")
HTTP_OK = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"      # the page table has no crawl time


def file_system(uri: str):
    """(pyarrow file system, path) of a Hadoop-style URI or a plain path."""
    from pyarrow import fs
    if uri.startswith("file:/"):
        uri = "file:///" + uri[5:].lstrip("/")
    for name in ("s3a://", "s3n://"):
        if uri.startswith(name):
            uri = "s3://" + uri[len(name):]
    return fs.FileSystem.from_uri(uri)


def parse_headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank
    continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line.startswith((" ", "\t")) and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def columns_of(headers: dict[str, str]) -> dict:
    row: dict = {}
    for column, name in HEADERS.items():
        value = headers.get(name)
        row[column] = (int(value) if value and value.isdigit() else None) if column in _INTS else value
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].split(":", 1)[-1]
    return row


def http_payload(body: bytes) -> bytes:
    """The payload of an HTTP response block, decoded; other blocks as they are."""
    if not body.startswith(b"HTTP/"):
        return body
    head, _, payload = body.partition(b"\r\n\r\n")
    return gzip.decompress(payload) if parse_headers(head).get("content-encoding") == "gzip" and payload else payload


def read_records(stream, keep=lambda row: True, payload: bool = True, seek: bool = True) -> Iterator[dict]:
    """Records of an open archive.  ``keep`` sees the header columns; payloads of
    other records are stepped over."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        block = [line]
        while (line := stream.readline()).strip():
            block.append(line)
        row = columns_of(parse_headers(b"".join(block)))
        size = row["content_length"] or 0
        if payload and keep(row):
            body = stream.read(size)
            if len(body) < size:
                raise ValueError("archive ends inside a record")
            row["payload"] = http_payload(body)
            yield row
            continue
        if keep(row):
            yield row | {"payload": None}
        if seek:
            stream.seek(size, io.SEEK_CUR)
        else:
            while size > 0 and (n := len(stream.read(min(size, 1 << 20)))):
                size -= n


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, length: int, refers_to: str | None = None) -> bytes:
    body = HTTP_OK + (gzip.compress(payload, 1, mtime=0) if payload else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {_DATE}"]
    if uri:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in uri))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    lines.append(f"X-Payload-Length: {length}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


@dataclass
class ArchiveFile(InputPartition):
    path: str


class _Filter:
    def __init__(self, filters):
        self.equal = [(f.attribute[0], (f.value,) if isinstance(f, EqualTo) else tuple(f.value)) for f in filters]

    def __call__(self, row: dict) -> bool:
        return all(row[c] in values for c, values in self.equal)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.filters = options["path"], _Filter([])
        self.payload = str(options.get("payload", "true")).lower() != "false"

    def pushFilters(self, filters):
        taken = [f for f in filters if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS]
        self.filters = _Filter(taken)
        for f in filters:
            if f not in taken and not (isinstance(f, IsNotNull) and f.attribute[0] in {g.attribute[0] for g in taken}):
                yield f

    def partitions(self):
        from pyarrow import fs as pafs
        fs, path = file_system(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [ArchiveFile(self.path)]
        files = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        names = sorted(f.path for f in files if f.type == pafs.FileType.File and f.path.endswith((".warc", ".warc.gz"))
                       and not f.base_name.startswith(("_", ".")))
        base = self.path.rstrip("/")
        return [ArchiveFile(base + n[len(path.rstrip("/")):]) for n in names]

    def read(self, partition):
        if partition is None or not partition.path:
            return
        fs, path = file_system(partition.path)
        packed = path.endswith(".gz")
        with fs.open_input_file(path) as raw:
            stream = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 20)
            for row in read_records(stream, self.filters, self.payload, seek=not packed):
                yield (*[row[c] for c in HEADERS], row["payload"])


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceWriter):
    """Takes rows (record_type, record_id, target_uri, payload_digest,
    payload_bytes, refers_to, payload)."""

    def __init__(self, options, schema):
        self.path, self.limit = options["path"].rstrip("/"), int(options.get("fileBytes", 256 << 20))
        self.schema = schema

    def write(self, rows):
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        try:
            for row in rows:
                data = record(row["record_type"], row["record_id"], row["target_uri"], bytes(row["payload"] or b""),
                              row["payload_digest"], row["payload_bytes"], row["refers_to"])
                if out is None or size + len(data) > self.limit:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc")
                    out, size = fs.open_output_stream(posixpath.join(path, f"_{names[-1]}")), 0
                out.write(data)
                size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages):
        fs, path = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            fs.move(posixpath.join(path, f"_{name}"), posixpath.join(path, name))

    def abort(self, messages):
        fs, path = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            fs.delete_file(posixpath.join(path, f"_{name}"))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive_pages(pages: DataFrame, path: str, least: int = 1000, file_bytes: int = 256 << 20) -> None:
    """Write a record per row (page_id, url, html).

    Of rows with equal payloads of at least ``least`` bytes, that with the
    largest page_id is the response and holds the payload; the others are
    revisits of it.  Null page_ids come below all others; rows that repeat the
    largest page_id are responses as well; null html is an empty payload.  The
    copies are found by (SHA-256, length), pre-aggregated per task.  If the groups are
    too many to be broadcast, rows are joined with them by that key, payloads
    included; AQE splits the partition of a large group, and that of the short pages,
    which have no key.  An empty table writes no records; extra columns are ignored;
    a very long page is one record.
    """
    register(pages.sparkSession)
    rows = only(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload").cast("long"))
    keyed = rows.withColumn("copy", F.when(F.col("n") >= least, F.sha2("payload", 256)))
    groups = (keyed.where("copy IS NOT NULL").groupBy("copy", F.col("n").alias("size"))
              .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    judged = keyed.join(groups, (keyed["copy"] == groups["copy"]) & (F.col("n") == F.col("size")), "left").drop(groups["copy"])
    revisit = F.col("size").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    (judged.select(F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
                   F.col("url").alias("target_uri"), F.sha1("payload").alias("payload_digest"), F.col("n").alias("payload_bytes"),
                   F.when(revisit, urn(F.col("original"))).alias("refers_to"),
                   F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))
     .write.format("warc").option("path", path).option("fileBytes", file_bytes).mode("append").save())


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("path", path).load()


def page_records(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the archives back:
    page_id, payload_bytes, payload_digest, record_type, refers_to.  Length and
    digest of a response come from the payload read, those of a revisit from its
    headers, for which the payloads of all records are stepped over."""
    path = scratch(spark, "warc")
    archive_pages(pages, path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    def records(kind: str, length: Column, digest: Column) -> DataFrame:
        return read_warc(spark, path, payload=kind == "response").where(F.col("record_type") == kind).select(
            page(F.col("record_id")).alias("page_id"), length.alias("payload_bytes"), digest.alias("payload_digest"),
            "record_type", page(F.col("refers_to")).alias("refers_to"))

    return (records("response", F.octet_length("payload").cast("long"), F.sha1("payload"))
            .unionByName(records("revisit", F.col("payload_bytes"), F.col("payload_digest"))))
