"""Packing documents into training sequences: bounded-space online best fit.

A document is its token ids and a closing id.  Whole sequences are cut off a
long document as they are; what is left goes to the fullest of at most
``windows`` open windows of the partition that still holds it.  When none
does, the fullest window is emitted: the head of the document fills it up and
the rest is placed again; a head or rest below ``min_cut`` ids is not cut off,
the window is then padded by fewer than ``2 * min_cut`` ids.  When a partition
ends, its open windows are handed on: groups of ``fan_in`` partitions pack the
leftovers again by the same rule, round by round, until one group is left.
Each group holds at most ``fan_in * windows`` windows, whatever the input.
The last group's windows are filled from end to end, and its last ids fall
into sequences whose lengths are powers of two, which need no padding.

Null and empty texts are the closing id alone.  Repeated rows are packed each.
An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import in_small_batches, keep, only

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, part long, ids binary")
_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                              "sequence_id", "offset", "part")] + [("ids", pa.binary())])


class Packer:
    """Open windows of one partition.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, windows: int, min_cut: int, first_id: int):
        self.size, self.most, self.min_cut, self.next_id = size, windows, min_cut, first_id
        self.order: list[tuple[int, int]] = []       # (fill, key) of the open windows, sorted
        self.open: dict[int, list] = {}
        self.done: list[tuple] = []
        self._key = 0

    def emit(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.done.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.size:
            self.emit([(doc_id, start, ids[:self.size], total)])
            start, ids = start + self.size, ids[self.size:]
        while len(ids):
            at = bisect.bisect_left(self.order, (self.size - len(ids) + 1, -1)) - 1
            if at >= 0:                              # the fullest that holds it
                fill, key = self.order.pop(at)
            elif len(self.order) < self.most:
                fill, key = 0, self._key
                self._key += 1
                self.open[key] = []
            else:                                    # none holds it: the fullest goes
                fill, key = self.order.pop()
                head = min(self.size - fill, len(ids) - self.min_cut)
                if head >= self.min_cut:
                    self.open[key].append((doc_id, start, ids[:head], total))
                    start, ids = start + head, ids[head:]
                self.emit(self.open.pop(key))
                continue
            self.open[key].append((doc_id, start, ids, total))
            if fill + len(ids) == self.size:
                self.emit(self.open.pop(key))
            else:
                bisect.insort(self.order, (fill + len(ids), key))
            return

    def close(self) -> None:
        """Fill the open windows from end to end; the last ids fall into lengths
        that are powers of two."""
        pieces = [p for _, key in reversed(self.order) for p in self.open[key]]
        self.order, self.open = [], {}
        left = sum(len(p[2]) for p in pieces)
        room, now = 0, []
        for doc_id, start, ids, total in pieces:
            while len(ids):
                if not room:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                    now = []
                head = min(room, len(ids))
                now.append((doc_id, start, ids[:head], total))
                start, ids = start + head, ids[head:]
                room, left = room - head, left - head
                if not room:
                    self.emit(now)

    def rows(self, part: int, finish: bool = False) -> Iterator[pa.RecordBatch]:
        out = [(*r, part, None) for r in self.done]
        self.done = []
        if finish:
            out += [(d, s, len(ids), 0, t, 0, 0, part, ids.astype("<u4").tobytes())
                    for _, key in self.order for d, s, ids, t in self.open[key]]
        for a in range(0, len(out), 10_000):
            cols = list(zip(*out[a:a + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _first_id(level: int, part: int) -> int:
    return (level << 58) | (part << 30)              # 2**30 sequences in each of 2**28 parts


def pack(docs: DataFrame, size: int = 1024, windows: int = 64, min_cut: int = 16, fan_in: int = 32,
         end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each round is written to the shared scratch folder, so a lost executor
    repeats tasks of one round only and no document is encoded twice.
    """
    path = vocabulary or tokens.vocabulary()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = Packer(size, windows, min_cut, _first_id(0, part))
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(tokens.encode(text.as_py(), path), np.uint32(end_id))
                packer.add(doc_id, 0, ids, len(ids))
                if len(packer.done) >= 20_000:
                    yield from packer.rows(part)
        yield from packer.rows(part, finish=True)

    def again(level: int, last: bool):
        def run(table: pa.Table) -> pa.Table:
            part = table.column("part")[0].as_py() // fan_in
            packer = Packer(size, windows, min_cut, _first_id(level, part))
            order = sorted(range(table.num_rows), key=lambda i: -table.column("length")[i].as_py())
            cols = [table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
            for i in order:
                packer.add(cols[0][i], cols[1][i], np.frombuffer(cols[2][i], "<u4"), cols[3][i])
            if last:
                packer.close()
            return pa.Table.from_batches(packer.rows(part, finish=True), schema=_ARROW)
        return run

    rounds = [keep(only(in_small_batches(docs), doc_id="long", text="string").mapInArrow(first, SCHEMA), "pack")]
    parts = rounds[0].agg(F.max("part")).first()[0]
    level = 0
    while parts is not None:
        level, parts = level + 1, parts // fan_in
        left = rounds[-1].where("ids IS NOT NULL")
        rounds.append(keep(left.groupBy(F.expr(f"part div {fan_in}")).applyInArrow(again(level, parts == 0), SCHEMA), "pack"))
        if parts == 0:
            break
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out.where("ids IS NULL").drop("part", "ids")
