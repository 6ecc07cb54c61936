"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all
non-ASCII characters.  Of the ``K``-gram hashes in each sliding window of
``SPAN - K + 1`` the smallest is kept as a fingerprint, so a span of ``SPAN``
words shared by a document and an item always shares a fingerprint at the same
place.  Document fingerprints are joined with the item fingerprints inside the
scan and every hit is extended: the words around it are compared and each
matching window of ``SPAN`` words marks its document words.  Items of fewer
words are one window, looked up by the hash of all their words.

The item index is made in tasks, in blocks of about ``block_bytes`` of item text.  If
all blocks together are at most ``broadcast_bytes``, measured, they are broadcast and
documents are not shuffled.  Else the fingerprints of documents and items are joined by
Spark, which tells the blocks that each document needs; a task then takes documents
through one block at a time, and what the blocks found is put together by document.
Pairs of a common fingerprint are taken in bounded chunks.  Words are compared by
64-bit hashes.

Null or wordless texts have no words (0, 0, 0, hash of the empty string, not
contaminated); null or wordless items have no window; an item without item_id
marks words but is not listed.  Repeated documents each give a row, a repeated
item_id counts once per document.  An empty benchmark hits nothing, an empty table of
documents gives no rows.  Texts are taken in slices of about 1 MB, a longer one by
itself and whole.  Extra columns are left out unless carried.
"""

from __future__ import annotations

import hashlib
import pickle
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_BYTES, gram_hashes, in_small_batches, keep, only, per_row, slices, span_hashes, text_buffer, word_spans

SPAN = 13
K = 7

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word, with the total last)."""
    data, off = text_buffer(column)
    start, end, first = word_spans(_WORD[data], off)
    return span_hashes(_LOWER[data], start, end), first


def winnow(words: np.ndarray, first: np.ndarray, span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of the kept k-grams of all texts."""
    grams, width = gram_hashes(words, k), span - k + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        other = grams[j:j + n]
        less = other <= low                      # the rightmost of equal ones
        np.copyto(low, other, where=less)
        at[less] = j
    row = per_row(first, len(words))
    inside = row[:n] == row[span - 1:span - 1 + n]   # windows within one text
    pos = np.unique((at + np.arange(n))[inside])
    return pos, grams[pos]


def range_chunks(lo: np.ndarray, hi: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the range, member) of all members of ranges [lo, hi), ``most`` at a time."""
    end = np.cumsum(hi - lo)
    for a in range(0, int(end[-1]) if len(end) else 0, most):
        member = np.arange(a, min(a + most, int(end[-1])))
        which = np.searchsorted(end, member, "right")
        yield which, member - (end - (hi - lo))[which] + lo[which]


class ItemBlock:
    """Words, windows and sorted fingerprints of a block of benchmark items."""

    def __init__(self, ids: list, texts: list, span: int = SPAN, k: int = K):
        self.ids, self.span, self.k = ids, span, k
        self.words, self.first = words_of(pa.array(texts, pa.large_string()))
        self.row = per_row(self.first, len(self.words))
        pos, fp = winnow(self.words, self.first, span, k)
        order = np.argsort(fp, kind="stable")
        self.fp, self.pos = fp[order], pos[order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        size = np.diff(self.first)
        for n in np.unique(size[(size > 0) & (size < span)]):
            rows = np.flatnonzero(size == n)
            h = np.array([gram_hashes(self.words[a:a + n], int(n))[0] for a in self.first[rows]], np.uint64)
            order = np.argsort(h, kind="stable")
            self.short[int(n)] = (h[order], rows[order])

    def hits(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(first document word, item row, words) of matching windows."""
        row = per_row(first, len(words))
        pos, fp = winnow(words, first, self.span, self.k)
        lo, hi = np.searchsorted(self.fp, fp, "left"), np.searchsorted(self.fp, fp, "right")
        reach = self.span - self.k
        for which, at in range_chunks(lo, hi, 200_000):
            d, i = pos[which], self.pos[at]
            drow, irow = row[d], self.row[i]
            steps = np.arange(-reach, self.k + reach)
            dd, ii = d[:, None] + steps, i[:, None] + steps
            ok = (dd >= first[drow][:, None]) & (dd < first[drow + 1][:, None]) \
                & (ii >= self.first[irow][:, None]) & (ii < self.first[irow + 1][:, None])
            same = ok & (words[np.clip(dd, 0, len(words) - 1)] == self.words[np.clip(ii, 0, len(self.words) - 1)])
            run = np.concatenate([np.zeros((len(d), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
            full = run[:, self.span:] - run[:, :-self.span] == self.span
            pair, shift = np.nonzero(full)
            yield d[pair] - reach + shift, irow[pair], self.span
        for n, (known, rows) in self.short.items():
            grams = gram_hashes(words, n)
            if not len(grams):
                continue
            inside = np.flatnonzero((row[:len(grams)] == row[n - 1:n - 1 + len(grams)]) & np.isin(grams, known))
            lo, hi = np.searchsorted(known, grams[inside], "left"), np.searchsorted(known, grams[inside], "right")
            for which, at in range_chunks(lo, hi, 200_000):
                yield inside[which], rows[at], n

    def prints(self) -> list[tuple[int, np.ndarray]]:
        """(words, distinct hashes): by which a document finds that it may hold windows."""
        return [(self.span, np.unique(self.fp)), *((n, np.unique(h)) for n, (h, _) in self.short.items())]


def item_blocks(benchmark: DataFrame, block_bytes: int, span: int, k: int) -> DataFrame:
    """(block, data): the index of each block of items, made by the task that reads
    them; a longer item is a block of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(ids: list, texts: list) -> pa.RecordBatch:
            data = pickle.dumps(ItemBlock(ids, texts, span, k), pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        ids, texts, size = [], [], 0
        for part in slices(batches, "text", block_bytes):
            for item_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if size and size + len(text or "") > block_bytes:
                    yield packed(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(item_id)
                texts.append(text or "")
                size += len(text or "")
        if ids:
            yield packed(ids, texts)

    made = only(benchmark, item_id="long", text="string").mapInArrow(run, "data binary")
    return keep(made.withColumn("block", F.monotonically_increasing_id()), "decon-blocks")


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_FOUND = "row__ long, at array<long>, size array<long>, items array<string>"


def _judged(total: np.ndarray, first: np.ndarray, marks: np.ndarray, items: list[list[str]]) -> list[pa.Array]:
    """The columns after doc_id: ``marks`` adds 1 where a window begins and takes it off
    where it ends."""
    n = len(total)
    row = per_row(first, int(first[-1]))
    hit = np.bincount(row[np.cumsum(marks[:-1]) > 0], minlength=n) if len(row) else np.zeros(n, np.int64)
    return [pa.array(total, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            pa.array((hit > 0) & (20 * hit >= total), pa.bool_())]


_NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, block_bytes: int = 32 << 20,
                  broadcast_bytes: int = 64 << 20, carry: str = "") -> DataFrame:
    """One row per document (SCHEMA).  ``carry``: further columns of ``docs``
    (a DDL string) returned as they are, for stages that filter."""
    if not 0 < k < span:
        raise ValueError("k must be below span")
    blocks = item_blocks(benchmark, block_bytes, span, k)
    extra = [c.strip().split(" ")[0] for c in carry.split(",") if c.strip()]
    frame = in_small_batches(docs).select("doc_id", "text", *[c for c in extra if c != "text"])
    schema = SCHEMA + (f", {carry}" if carry else "")
    if (blocks.agg(F.sum(F.octet_length("data"))).first()[0] or 0) > broadcast_bytes:
        return _through_blocks(frame, blocks, span, k, extra, schema)
    held = docs.sparkSession.sparkContext.broadcast([bytes(r["data"]) for r in blocks.select("data").collect()])   # at most broadcast_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [pickle.loads(data) for data in held.value]
        for batch in slices(batches, "text", HASH_BYTES):
            words, first = words_of(batch.column(1))
            n, row = batch.num_rows, per_row(first, len(words))
            marks = np.zeros(len(words) + 1, np.int64)
            found: dict[int, set] = {}
            for index in indexes:
                for at, item, size in index.hits(words, first):
                    np.add.at(marks, at, 1)
                    np.add.at(marks, at + size, -1)
                    for r, i in np.unique(np.stack([row[at], item], 1), axis=0).tolist() if len(at) else ():
                        found.setdefault(r, set()).add(index.ids[i])
            items = [sorted(str(i) for i in found.get(r, ()) if i is not None) for r in range(n)]
            columns = [batch.column(0).cast(pa.int64()), *_judged(np.diff(first), first, marks, items)]
            columns += [batch.column(batch.schema.get_field_index(c)) for c in extra]
            yield pa.RecordBatch.from_arrays(columns, names=[*_NAMES, *extra])

    return frame.mapInArrow(run, schema)


def _through_blocks(frame: DataFrame, blocks: DataFrame, span: int, k: int, extra: list[str], schema: str) -> DataFrame:
    """The same for an index of any size: see the module's docstring."""
    rows = keep(frame.withColumn("row__", F.monotonically_increasing_id()), "decon-rows")

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                for n, h in pickle.loads(data.as_py()).prints():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), block)), pa.array(np.full(len(h), n, np.int32)),
                                                      pa.array(h.view(np.int64))], ["block", "words", "print"])

    wanted = keep(blocks.select("block", "data").mapInArrow(of_items, "block long, words int, print long"), "decon-prints")
    lengths = [r[0] for r in wanted.select("words").distinct().collect()]           # at most ``span`` numbers

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASH_BYTES):
            words, first = words_of(batch.column(1))
            row = per_row(first, len(words))
            for n in lengths:
                if n == span:
                    at, h = winnow(words, first, span, k)
                else:
                    h = gram_hashes(words, n)
                    at = np.flatnonzero(row[:len(h)] == row[n - 1:n - 1 + len(h)])
                    h = h[at]
                pair = np.unique(np.stack([row[at].astype(np.uint64), h], 1), axis=0) if len(at) else np.zeros((0, 2), np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(pair[:, 0].astype(np.int64))),
                                                  pa.array(np.full(len(pair), n, np.int32)), pa.array(pair[:, 1].copy().view(np.int64))],
                                                 ["row__", "words", "print"])

    prints = rows.select("row__", "text").mapInArrow(of_documents, "row__ long, words int, print long")
    needed = prints.join(wanted, ["words", "print"]).select("row__", "block").distinct()
    at_block = keep(blocks.select("block", "data"), "decon-index")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if right.num_rows:
            index = pickle.loads(right.column("data")[0].as_py())
            for part in slices(iter(left.select(["row__", "text"]).combine_chunks().to_batches()), "text"):
                words, first = words_of(part.column(1))
                row, found = per_row(first, len(words)), {}
                for at, item, size in index.hits(words, first):
                    for r in np.unique(row[at]).tolist():
                        own = row[at] == r
                        windows, names = found.setdefault(r, (set(), set()))
                        windows.update((int(x), size) for x in np.unique(at[own] - first[r]))
                        names.update(str(index.ids[i]) for i in np.unique(item[own]).tolist() if index.ids[i] is not None)
                for r, (windows, names) in found.items():
                    out.append((part.column(0)[r].as_py(), [x for x, _ in windows], [n for _, n in windows], sorted(names)))
        cols = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=["row__", "at", "size", "items"])

    # a block that many documents need is searched by many tasks: shares of the rows hold
    # about 32 MB of text each, so a group is bounded even if all documents need the block
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = F.pmod(F.xxhash64("row__"), F.lit(1 + size // (32 << 20))).cast("int")
    needed = keep(needed.withColumn("share", share), "decon-needed")
    texts = needed.join(rows.select("row__", "text"), "row__")
    wide = needed.select(F.col("block").alias("of_block"), F.col("share").alias("of_share")).distinct()
    copies = at_block.join(wide, F.col("block") == F.col("of_block")).select("of_block", "of_share", "data")
    found = (texts.groupBy("block", "share").cogroup(copies.groupBy("of_block", "of_share")).applyInArrow(search, _FOUND))
    together = found.groupBy("row__").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("size")).alias("size"),
                                          F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASH_BYTES):
            words, first = words_of(batch.column(1))
            marks = np.zeros(len(words) + 1, np.int64)
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
            for begin, at, size in zip(first.tolist(), column("at").to_pylist(), column("size").to_pylist()):
                if at:
                    np.add.at(marks, begin + np.array(at), 1)
                    np.add.at(marks, begin + np.array(at) + np.array(size), -1)
            columns = [batch.column(0).cast(pa.int64()), *_judged(np.diff(first), first, marks, [x or [] for x in column("items").to_pylist()])]
            yield pa.RecordBatch.from_arrays(columns + [column(c) for c in extra], names=[*_NAMES, *extra])

    return rows.join(together, "row__", "left").select("doc_id", "text", *[c for c in extra if c != "text"], "at", "size", "items").mapInArrow(judge, schema)
