"""Helpers shared by the operators of this folder.

Texts are handled in Arrow batches: the UTF-8 bytes of a whole batch lie in one
buffer, so words and n-grams are hashed with numpy over the batch, not per row.
"""

from __future__ import annotations

import gc
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)                      # odd: has an inverse mod 2**64
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# Of a task's texts: what a Python worker is handed at once, and what is hashed at once
# (which takes some 40 bytes of scratch arrays for each byte).
BATCH_BYTES, HASH_BYTES = 2 << 20, 1 << 18


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; its session hands rows to Python in Arrow batches of at most
    BATCH_BYTES (or what it has, if less; one longer row is a batch).  Spark's own 10,000
    rows of whole texts stand in the executor's native memory and in the worker's, which
    keep that room.  The setting stays, because ``docs`` is read after this returns."""
    spark, name = docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return docs


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir`` of the session."""
    from ..session import checkpoint_root
    return f"{checkpoint_root(spark)}/faclake-llm/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.  This cuts the
    lineage, and the shuffle files of the written step can go: Spark removes them
    once the driver has collected their handles."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the files of a step that ``keep`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def only(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns cast to the given types; extra columns are left out."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in cols.items()])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches by rows so that the texts of each hold about ``most`` bytes;
    a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def word_spans(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each run of word bytes, runs ending at texts' ends,
    and for each text the index of its first word (with the total last)."""
    n = len(is_word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    edge = np.zeros(n, bool)
    starts_at = off[:-1][off[:-1] < n]
    edge[starts_at] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    start = np.flatnonzero(is_word & (~before | edge))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~is_word[1:] | edge[1:]
    end = np.flatnonzero(is_word & after) + 1
    return start, end, np.searchsorted(start, off)


_POWERS: dict[str, np.ndarray] = {}


def _powers(base: np.uint64, n: int, key: str) -> np.ndarray:
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(1 << (n - 1).bit_length(), HASH_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if size <= 1 << 21:          # longer texts make their own
            _POWERS[key] = have
    return have[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte span, from prefix sums."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, n, "up"), out=total[1:])
    h = (total[end] - total[start]) * _powers(_BACK, n + 1, "down")[start]
    return mix(h + (end - start).astype(np.uint64) * _ODD)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (positions 0 .. len - k)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        h *= _STEP
        h += words[j:j + n]
    return mix(h)


def per_row(first: np.ndarray, count: int) -> np.ndarray:
    """Row index of each of ``count`` items, given each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [lo, hi): (index of the range, member) of every member."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    first = np.cumsum(size) - size
    return which, np.arange(int(size.sum())) - first[which] + lo[which]
