"""Removing repeated byte strings with a column-wise multi-string BWT.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts
earlier: in a smaller doc_id, or earlier in the same document.

Whole documents cannot share one suffix order on one machine, so the collection
is split where equal strings stay together.  The smallest ``GRAM``-byte hash in
each LENGTH-byte window is the window's key; a run of windows with one key is a
segment (a string of at most ``most_windows + LENGTH - 1`` bytes), and equal
windows always have equal keys.  Keys of one segment only hold no repeat.  Equal
segments are one string, kept with its earliest place; every later copy goes
whole.  The strings of keys with several of them, or with a repeat inside one, are
dealt to collections of bounded size, and each collection's Burrows-Wheeler transform and
longest common prefixes are built column by column: a round inserts one symbol of every
string, counted from its end, reading the transform and the prefixes of the round before
from files and writing the next ones.  Neighbours with a common prefix of LENGTH
are equal windows; all but the earliest of them go.

A key with more than ``most_strings`` distinct segments is split further: its
windows are keyed by a 128-bit digest of all their bytes and reduced to the earliest
place each, so no collection grows with a common phrase.

Segments and strings are told apart by 64-bit hashes beside their key and length.
Null texts are empty.  Rows that repeat a doc_id are one document: equal starts
are not earlier than each other, and each row is cleaned by its own text.  Rows
without doc_id count as one document after all others.  An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BACK, _BYTE, _STEP, _powers, drop, keep, mix, ranges, slices, span_hashes, text_buffer

LENGTH = 100
GRAM = 32
_LAST = (1 << 63) - 1                # stands for a null doc_id
_NONE = 0xFF                         # no symbol yet; not a byte of UTF-8


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, n, "up"), out=total[1:])
    return mix((total[k:] - total[:-k]) * _powers(_BACK, n + 1, "down")[:n - k + 1])


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window, by minima from both ends of blocks."""
    n = len(values) - width + 1
    block = np.concatenate([values, np.full(-len(values) % width, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
    up = np.minimum.accumulate(block, axis=1).ravel()
    down = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1:width - 1 + n])


def segments(data: np.ndarray, off: np.ndarray, length: int, gram: int, most: int) -> tuple[np.ndarray, ...]:
    """(text, first byte in the buffer, windows, key, inner) of each segment.  ``inner``: it may hold equal windows, because a window that is not its
    last begins with the key's gram, which the next one then holds once more."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    grams = _gram_hashes(data, gram)
    key = _window_min(grams, length - gram + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = row[:n] == row[length - 1:]
    cut = np.ones(n, bool)
    cut[1:] = (key[1:] != key[:-1]) | (inside[1:] != inside[:-1]) | (row[1:n] != row[:n - 1])
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, n))
    start, size = start[inside[start]], size[inside[start]]
    pieces = -(-size // most)
    which, nth = ranges(np.zeros(len(size), np.int64), pieces)
    start, size = start[which] + nth * most, np.minimum(size[which] - nth * most, most)
    begins = np.concatenate([[0], np.cumsum(grams[:n] == key)])
    inner = begins[start + size - 1] > begins[start]
    return row[start], start, size, key[start], inner


class ColumnBwt:
    """Transform and common prefixes (up to ``cap``) of a collection, built by
    inserting one symbol per string each round.  Rows are the suffixes in order;
    the first m are the strings' ends.  Between rounds both columns (prefix << 8 |
    symbol) lie in a file that is read and written from front to back.

    Strings join late enough to begin in the same last round, so rows of short ones
    are not carried along.  The rows that have a symbol are kept by (symbol, row):
    row m + i is the image of the i-th.  A round looks its new rows up there and
    merges them; nothing but the new rows is sorted."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, cap: int):
        self.size, self.cap, self.m = size, cap, len(start)
        rows = self.m + int(size.sum())
        kind, self.shift = (np.uint32, 24) if rows < 1 << 24 else (np.uint64, 32)      # symbol << shift | row
        self.order, self.spare, self.moved = (np.empty(rows, kind) for _ in range(3))
        self.at, self.known = np.empty(rows, np.intp), 0
        with tempfile.TemporaryFile() as self.file:          # of this task only
            self._write(np.full(self.m, _NONE, np.uint16))
            place = np.arange(self.m)
            for left in range(int(size.max(initial=0)), 0, -1):
                self._round(place, np.flatnonzero(size >= left), data, start + (left - 1))
            columns = self._read()
            self.symbols, self.prefixes = columns.astype(np.uint8), (columns >> 8).astype(np.uint8)
        del self.file, self.order, self.spare, self.moved, self.at

    def _write(self, columns: np.ndarray) -> None:
        self.file.seek(0)
        self.file.write(columns)
        self.file.flush()

    def _read(self) -> np.ndarray:
        columns = np.empty(self.file.tell() // 2, np.uint16)
        self.file.seek(0)
        self.file.readinto(columns)
        return columns

    def _round(self, place, active, data, at) -> None:
        m, kind, columns = self.m, self.order.dtype.type, self._read()
        only_row = kind((1 << self.shift) - 1)
        rows, symbols = place[active], data[at[active]]
        columns[rows] ^= symbols ^ np.uint8(_NONE)
        wanted = symbols.astype(kind) << kind(self.shift) | rows.astype(kind)
        by = np.argsort(wanted)
        wanted = wanted[by]
        gap = np.searchsorted(self.order[:self.known], wanted)      # images before each new one
        fresh = gap + np.arange(len(gap))
        old = np.ones(len(columns) + len(fresh), bool)
        old[m + fresh] = False
        order = self.spare[:self.known + len(fresh)]
        order[old[m:]], order[fresh] = self.order[:self.known], wanted
        # common prefixes of the new suffixes and of those right after them
        after = fresh + 1
        if after[-1] == len(order):
            after = after[:-1]
        near = np.concatenate([fresh, after[old[m + after]]])
        row, before = order[near], order[near - 1]          # of the first: overruled below
        same = np.flatnonzero((row >> kind(self.shift) == before >> kind(self.shift)) & (near > 0))
        value = np.zeros(len(near), np.uint16)
        if len(same):
            low = (before[same] & only_row).astype(np.int64) + 1
            back = np.argsort(-low)                         # descending, so only the ranges are read
            same = same[back]
            pairs = np.stack([low[back], (row[same] & only_row).astype(np.int64) + 1], 1).ravel()
            least = np.minimum.reduceat(np.append(columns, np.uint16(0)), pairs)[::2] >> 8
            value[same] = np.minimum(least, self.cap - 1) + 1
        # merge the new rows into the columns; the rows behind them move on
        merged = np.empty(len(old), np.uint16)
        merged[old] = columns
        merged[m + fresh] = _NONE
        near += m
        merged[near] = merged[near] & 0xFF | value << 8
        moved = np.repeat(np.arange(len(gap) + 1, dtype=kind), np.diff(gap + m, prepend=0, append=len(columns)))
        was = np.bitwise_and(order, only_row, out=self.at[:len(order)], casting="unsafe")
        order += np.take(moved, was, out=self.moved[:len(order)], mode="clip")
        self.order, self.spare, self.known = self.spare, self.order, len(order)
        place[active[by]] = m + fresh
        self._write(merged)

    @staticmethod
    def _sorted_rows(symbols: np.ndarray) -> np.ndarray:
        order = pc.array_sort_indices(pa.array(symbols)).to_numpy().view(np.int64)     # stable; bytes are sorted by counting
        return order[:len(symbols) - int(np.count_nonzero(symbols == _NONE))]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, offset, class) of every window of ``cap`` bytes; equal windows
        have one class."""
        order = self._sorted_rows(self.symbols)
        image = np.zeros(len(self.symbols), np.int64)
        image[order] = self.m + np.arange(len(order))
        group = np.cumsum(self.prefixes < self.cap)
        place, out = np.arange(self.m), []
        for depth in range(1, int(self.size.max(initial=0)) + 1):
            active = np.flatnonzero(self.size >= depth)
            place[active] = image[place[active]]
            if depth >= self.cap:
                out.append((active, self.size[active] - depth, group[place[active]]))
        return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))


def later_windows(strings: list[bytes], doc: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows that are not the earliest of their class,
    in order; string i lies at byte at[i] of document doc[i]."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(s) for s in strings], np.int64)
    start = np.cumsum(size) - size
    string, offset, group = ColumnBwt(np.frombuffer(b"".join(strings), np.uint8), start, size, length).windows()
    where = at[string] + offset
    order = np.lexsort((where, doc[string], group))
    lead = np.ones(len(order), bool)
    lead[1:] = group[order][1:] != group[order][:-1]
    first = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))] if len(order) else order
    later = order[(doc[string[order]] != doc[string[first]]) | (where[order] != where[first])]
    later = later[np.lexsort((offset[later], string[later]))]
    return string[later], offset[later]


def _runs(string: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, windows) of the runs of consecutive windows."""
    if not len(string):
        return string, offset, offset
    cut = np.ones(len(string), bool)
    cut[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
    lead = np.flatnonzero(cut)
    return string[lead], offset[lead], np.diff(np.append(lead, len(string)))


# Bits of the filter of shared keys: 16 for a key, 32 MB of memory at most.
FILTER_BITS = 1 << 28


def _key_filter(keys: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of the keys' lowest bits; a key whose bit is not set is none of them."""
    bits = min(most, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
    bit = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(bit).alias("nth")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.toLocalIterator():
        part = np.frombuffer(r["map"], np.uint8)
        out[(r["nth"] - 1) * 4096:][:len(part)] = part
    return out


def _may_hold(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = key & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_SLICE = 1 << 18                      # bytes of text at a time: their 64-bit columns stay in the cache
_SEGMENT = "doc long, variant long, at long, windows int, key long, content long, inner boolean"


def _variant(text: str):
    return F.xxhash64(text)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_windows: int = 128, most_strings: int = 30_000,
                   collection_bytes: int = 1 << 18, spans: bool = False) -> DataFrame:
    """One row per document (SCHEMA); with ``spans`` also the removed byte spans
    and the text that is left."""
    if not 0 < gram <= length <= 250:
        raise ValueError("lengths up to 250 bytes")
    done = lambda df, name: keep(df, f"suffix-{name}")
    # rows that repeat a doc_id are told apart by a hash of the text
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.col("doc_id").isNull().alias("unnamed"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .select("doc", _variant("text").alias("variant"), "text", "unnamed")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            *_, key, inner = segments(*text_buffer(batch.column(2)), length, gram, most_windows)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(inner)], names=["key", "inner"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            data, off = text_buffer(batch.column(2))
            found = segments(data, off, length, gram, most_windows)
            likely = np.flatnonzero(_may_hold(bitmap.value, found[3]))
            if not len(likely):
                continue
            row, start, size, key, inner = (column[likely] for column in found)
            content, row_at = span_hashes(data, start, start + size + length - 1), pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row_at), batch.column(1).take(row_at), pa.array(start - off[row]), pa.array(size.astype(np.int32)),
                 pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(inner)],
                names=["doc", "variant", "at", "windows", "key", "content", "inner"])

    every = texts.mapInArrow(keys, "key long, inner boolean")
    shared = done(every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner")).where("n > 1 OR inner").select("key"), "keys")
    # segments of other keys are left out before they are shuffled; the join drops the few that pass the filter
    bitmap = docs.sparkSession.sparkContext.broadcast(_key_filter(shared))
    found = done(texts.mapInArrow(cut, _SEGMENT).join(shared, "key"), "found")
    drop(shared)
    place = F.struct("doc", "at", "variant")
    strings = done(found.groupBy("key", "content", "windows").agg(F.min(place).alias("first"), F.max("inner").alias("inner"))
                   .select("key", "content", "windows", "first.doc", "first.at", "first.variant", "inner"), "strings")
    # a single string without inner repeats has nothing to be compared with
    sorted_ = (strings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("inner").alias("any_inner")).where("n > 1 OR any_inner")
               .select("key", (F.col("n") > most_strings).alias("large")))
    listed = (strings.join(sorted_, "key").groupBy("doc", "variant")
              .agg(F.collect_list(F.struct("key", "content", "windows", "at", "large")).alias("own")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings' bytes; of those of large keys, each window by itself."""
        names = ["doc", "at", "key", "content", "windows", "nth", "window", "string"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for batch in slices(batches, "text", 1 << 20):
            out = []
            for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                for s in own:
                    a, n = s["at"], s["windows"]
                    if not s["large"]:
                        out.append((doc, a, s["key"], s["content"], n, None, None, data[a:a + n + length - 1]))
                        continue
                    out += [(doc, a + i, s["key"], s["content"], n, i, hashlib.blake2b(data[a + i:a + i + length], digest_size=16).digest(), None)
                            for i in range(n)]
            for a in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a:a + 20_000]), kinds)], names=names)

    pieces = done(texts.join(listed, ["doc", "variant"]).select("doc", "text", "own").mapInArrow(
        fetch, "doc long, at long, key long, content long, windows int, nth int, window binary, string binary"), "pieces")
    total = pieces.agg(F.sum(F.octet_length("string"))).first()[0] or 0
    collections = max(1, -(-total // collection_bytes))

    def build(table: pa.Table) -> pa.Table:
        doc, at = table.column("doc").to_numpy(), table.column("at").to_numpy()
        string, offset = later_windows([s.as_py() for s in table.column("string")], doc, at, length)
        string, offset, count = _runs(string, offset)
        rows = pa.array(string)
        return pa.table({"key": table.column("key").take(rows), "content": table.column("content").take(rows),
                         "windows": table.column("windows").take(rows), "nth": pa.array(offset.astype(np.int32)),
                         "run": pa.array(count.astype(np.int32))})

    inner = pieces.where("string IS NOT NULL").groupBy(F.pmod("key", F.lit(collections))).applyInArrow(
        build, "key long, content long, windows int, nth int, run int")
    single = pieces.where("string IS NULL")
    earliest = single.groupBy("window").agg(F.min(F.struct("doc", "at")).alias("first"))
    outer = (single.join(earliest, "window").where("first.doc <> doc OR first.at <> at")
             .select("key", "content", "windows", "nth", F.lit(1).alias("run")))
    later = done(inner.unionByName(outer), "later")
    drop(pieces)

    # the earliest copy of a string loses its later windows, every other copy all of them
    same = ["key", "content", "windows"]
    heads = strings.select(*same, F.col("doc").alias("doc0"), F.col("at").alias("at0"))
    judged = found.join(heads, same)
    whole = judged.where("doc <> doc0 OR at <> at0").select("doc", "variant", "at", (F.col("at") + F.col("windows")).alias("end"))
    part = strings.join(later, same).select("doc", "variant", (F.col("at") + F.col("nth")).alias("at"), (F.col("at") + F.col("nth") + F.col("run")).alias("end"))
    # an equal place in another row of the same document is the same start
    twin = judged.where("doc = doc0 AND at = at0").join(strings.select(*same, F.col("variant").alias("v0")), same).where("variant <> v0") \
        .join(later, same).select("doc", "variant", (F.col("at") + F.col("nth")).alias("at"), (F.col("at") + F.col("nth") + F.col("run")).alias("end"))
    runs = done(whole.unionByName(part).unionByName(twin).groupBy("doc", "variant").agg(F.collect_list(F.struct("at", "end")).alias("runs")), "runs")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            out = []
            for doc, text, own, unnamed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data, merged = text.encode(), []
                for a, b in sorted((r["at"], r["end"] + length - 1) for r in own or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                left = b"".join(data[a:b] for a, b in zip([0] + [m[1] for m in merged], [m[0] for m in merged] + [len(data)]))
                out.append((None if unnamed else doc, len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(),
                            [{"start": a, "end": b} for a, b in merged] if spans else None, left if spans else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            take = 7 if spans else 5
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][:take]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(zip(*out), kinds))[:take]], names=names)

    return texts.join(runs, ["doc", "variant"], "left").select("doc", "text", "runs", "unnamed").mapInArrow(
        clean, SCHEMA + (", spans array<struct<start: long, end: long>>, kept binary" if spans else ""))
