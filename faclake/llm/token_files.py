"""Token ids in seekable zstandard files: a PySpark Python data source (format
``token_frames``).

A file is a row of independent zstandard frames and ends with the seek table of the
public seekable format: each frame's compressed and decompressed size and checksum
(low 32 bits of XXH64 of its decompressed bytes).  A frame holds up to
``frameIds`` little-endian unsigned 32-bit ids of consecutive documents; a long
document goes on in the next frame.  The last entry of the table is a skippable
frame with the document index (doc_id and number of ids of each document), so any
zstandard program decompresses the file to the plain ids.

A reader takes the table and the index, then decompresses and verifies only the
frames that hold requested documents: filters on doc_id are pushed down, first to
whole files (smallest and largest doc_id in the manifest), then to frames.

Documents lie in ascending doc_id order over all files, null doc_ids first; rows
that share a doc_id are ordered by a hash of their text.  Null and empty texts are
the end id alone.  An empty table makes no file, and reads as no rows.  Extra columns
are ignored.  A task writes files under unique temporary names; the job's commit
gives them their names and writes the manifest last, so repeated or speculative
tasks leave nothing that a reader sees.
"""

from __future__ import annotations

import io
import json
import posixpath
import struct
import uuid
import zlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    WriterCommitMessage)

from . import tokens
from .common import only, scratch
from .warc import file_system

SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                    ("ids", pa.binary())])
MANIFEST, SUFFIX = "_manifest.json", ".ids.zst"
# fixed values of the zstandard seekable format
SKIPPABLE, TABLE_FRAME, SEEKABLE, HAS_CHECKSUM = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


class FormatError(ValueError):
    pass


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """One file: ``add`` documents in order, then ``close``."""

    def __init__(self, out, frame_ids: int = 1 << 16, level: int = 3):
        self.out, self.frame_bytes = out, 4 * frame_ids
        self.packer = zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.ids = self.written = 0
        self.open = bytearray()

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.ids += len(ids)
        data = memoryview(ids.astype("<u4").tobytes())
        while len(self.open) + len(data) >= self.frame_bytes:
            room = self.frame_bytes - len(self.open)
            self.open += data[:room]
            data = data[room:]
            self._frame()
        self.open += data

    def _put(self, data: bytes, size: int, check: int) -> None:
        self.out.write(data)
        self.written += len(data)
        self.table.append((len(data), size, check))

    def _frame(self) -> None:
        raw = bytes(self.open)
        self._put(self.packer.compress(raw), len(raw), checksum(raw))
        self.open = bytearray()

    def close(self) -> dict:
        """Write index and seek table; what the manifest says of the file."""
        if self.open:
            self._frame()
        null = np.array([i is None for i in self.doc_ids], np.uint8)
        raw = (struct.pack("<Q", len(null)) + null.tobytes() + np.array([i or 0 for i in self.doc_ids], "<i8").tobytes()
               + np.array(self.lengths, "<u8").tobytes())
        index = self.packer.compress(raw)
        self._put(struct.pack("<II", SKIPPABLE, len(index)) + index, 0, checksum(raw))
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), HAS_CHECKSUM, SEEKABLE)
        self.out.write(struct.pack("<II", TABLE_FRAME, len(entries) + len(footer)) + entries + footer)
        known = [i for i in self.doc_ids if i is not None]
        return {"docs": len(null), "ids": self.ids, "nulls": int(null.sum()),
                "least": min(known, default=None), "most": max(known, default=None)}


class FrameReader:
    """Reads a file; ``frames_read`` counts the frames that were decompressed."""

    def __init__(self, stream):
        self.stream, self.frames_read = stream, 0
        size = stream.seek(0, io.SEEK_END)
        if size < 17:
            raise FormatError("too short for a seek table")
        stream.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE or flags != HAS_CHECKSUM or 17 + 12 * n > size or not n:
            raise FormatError("no seek table with checksums at the end")
        stream.seek(size - 17 - 12 * n)
        head = stream.read(8 + 12 * n)
        if struct.unpack("<II", head[:8]) != (TABLE_FRAME, 12 * n + 9):
            raise FormatError("damaged seek table")
        table = np.frombuffer(head[8:], "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(table[:, 0])])       # place of each frame in the file
        self.first = np.concatenate([[0], np.cumsum(table[:-1, 1])]) // 4   # first id of each data frame
        self.table = table
        if self.at[-1] + 17 + 12 * n != size:
            raise FormatError("sizes of the seek table do not add up")
        raw = self._unpacked(n - 1, skip=8)
        docs = struct.unpack("<Q", raw[:8])[0]
        self.null = np.frombuffer(raw, np.uint8, docs, 8).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 + docs)
        self.ends = np.cumsum(np.frombuffer(raw, "<u8", docs, 8 + 9 * docs).astype(np.int64))
        if table[-1, 1] or (self.ends[-1] if docs else 0) != self.first[-1]:
            raise FormatError("index and frames disagree")

    def _unpacked(self, frame: int, skip: int = 0) -> bytes:
        self.stream.seek(int(self.at[frame]) + skip)
        packed = self.stream.read(int(self.table[frame, 0]) - skip)
        try:
            raw = zstandard.ZstdDecompressor().decompress(packed)
        except zstandard.ZstdError as e:
            raise FormatError(f"frame {frame}: {e}") from e
        if checksum(raw) != self.table[frame, 2] or (not skip and len(raw) != self.table[frame, 1]):
            raise FormatError(f"frame {frame}: wrong checksum or size")
        return raw

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int | None, int, int, Iterator[bytes]]]:
        """(doc_id, first id, number of ids, pieces of the ids' bytes) of the documents
        that the mask ``wanted`` marks (all without it), in order.  Pieces must be
        taken before the next document."""
        have, raw = -1, b""
        for i in range(len(self.ends)) if wanted is None else np.flatnonzero(wanted):
            end = int(self.ends[i])
            begin = int(self.ends[i - 1]) if i else 0

            def pieces(begin=begin, end=end):
                nonlocal have, raw
                at = begin
                while at < end:
                    frame = int(np.searchsorted(self.first[:-1], at, "right")) - 1
                    if frame != have:
                        have, raw = frame, self._unpacked(frame)
                        self.frames_read += 1
                    stop = min(end, int(self.first[frame + 1]))
                    yield raw[4 * (at - int(self.first[frame])):4 * (stop - int(self.first[frame]))]
                    at = stop
            yield (None if self.null[i] else int(self.doc_ids[i])), begin, end - begin, pieces()


@dataclass
class TokenFile(InputPartition):
    path: str
    start: int


class TokenReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.with_ids = options["path"].rstrip("/"), str(options.get("ids", "true")).lower() != "false"
        self.wanted: set[int] | None = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("doc_id",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value) - {None}
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self):
        fs, path = file_system(self.path)
        with fs.open_input_stream(posixpath.join(path, MANIFEST), compression=None) as stream:
            files = json.loads(stream.read())["files"]
        out, start = [], 0
        for f in files:
            if self.wanted is None or any(f["least"] is not None and f["least"] <= w <= f["most"] for w in self.wanted):
                out.append(TokenFile(f"{self.path}/{f['name']}", start))
            start += f["ids"]
        return out

    def read(self, partition):
        if partition is None or not partition.path:
            return
        fs, path = file_system(partition.path)
        with fs.open_input_file(path) as stream:
            reader, rows, held = FrameReader(stream), [], 0
            wanted = None
            if self.wanted is not None:
                wanted = np.isin(reader.doc_ids, np.array(sorted(self.wanted), np.int64)) & ~reader.null
            for doc_id, start, n, pieces in reader.documents(wanted):
                crc, data = 0, bytearray()
                for piece in pieces:
                    crc = zlib.crc32(piece, crc)
                    if self.with_ids:
                        data += piece
                rows.append((doc_id, partition.start + start, n, crc, bytes(data) if self.with_ids else None))
                held += len(data) + 64
                if held > 1 << 22:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    task: int
    files: list


class TokenWriter(DataSourceArrowWriter):
    """Takes batches of (doc_id, text), in order within and over the tasks."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.file_bytes, self.frame_ids = int(options.get("fileBytes", 256 << 20)), int(options.get("frameIds", 1 << 16))
        self.end_id, self.vocabulary = int(options.get("endId", 0)), options["vocabulary"]

    def write(self, iterator):
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        files, out, stream = [], None, None

        def finish():
            files[-1] |= out.close()
            stream.close()

        for batch in iterator:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None or out.written >= self.file_bytes:
                    if out is not None:
                        finish()
                    files.append({"name": f"part-{uuid.uuid4().hex}{SUFFIX}"})
                    stream = fs.open_output_stream(posixpath.join(path, f"_{files[-1]['name']}"), compression=None)
                    out = FrameWriter(stream, self.frame_ids)
                out.add(doc_id, np.append(tokens.encode(text.as_py(), self.vocabulary), np.uint32(self.end_id)))
        if out is not None:
            finish()
        return Written(TaskContext.get().partitionId(), files)

    def commit(self, messages):
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.task) for f in m.files]
        for f in files:
            fs.move(posixpath.join(path, f"_{f['name']}"), posixpath.join(path, f["name"]))
        fresh = posixpath.join(path, f"_{uuid.uuid4().hex}")
        with fs.open_output_stream(fresh, compression=None) as out:
            out.write(json.dumps({"files": files}).encode())
        fs.move(fresh, posixpath.join(path, MANIFEST))

    def abort(self, messages):
        fs, path = file_system(self.path)
        for f in (f for m in messages if m for f in m.files):
            fs.delete_file(posixpath.join(path, f"_{f['name']}"))


class TokenSource(DataSource):
    @classmethod
    def name(cls):
        return "token_frames"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TokenReader(self.options)

    def writer(self, schema, overwrite):
        return TokenWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, files: int | None = None,
                 file_bytes: int = 256 << 20, frame_ids: int = 1 << 16) -> None:
    """Encode every text once and write the ids of all documents, each followed by
    ``end_id``, in ascending doc_id order.  Documents are dealt by ranges of (doc_id,
    hash of the text, place in the scan), so a doc_id that repeats, or equal rows,
    spread over tasks; no task sees more than its range."""
    register(docs.sparkSession)
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (only(docs, doc_id="long", text="string").withColumn("h", F.xxhash64("text"))
            .withColumn("scan", F.monotonically_increasing_id()))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("scan").asc()]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
     .write.format("token_frames").option("path", path).option("vocabulary", vocabulary or tokens.vocabulary())
     .option("endId", end_id).option("fileBytes", file_bytes).option("frameIds", frame_ids).mode("append").save())


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids (null
    unless wanted).  A filter on doc_id reads only the frames of those documents."""
    register(spark)
    return spark.read.format("token_frames").option("path", path).option("ids", str(ids).lower()).load()


def token_rows(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to token files in the shared scratch folder and read them back."""
    path = scratch(docs.sparkSession, "token-files")
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path, ids=False).drop("ids")
