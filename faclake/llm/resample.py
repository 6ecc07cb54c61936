"""Importance resampling of documents towards a target text distribution.

Every document and every target text is a bag of hashed word n-grams.  A bucket's
gain is the scaled log ratio of its smoothed shares in target and corpus; a
document's weight is the floored mean gain of its features; a Gumbel draw hashed
from the document's id turns weights into a sample without replacement: the
highest scores are drawn.

Features are taken by batch concatenation: the texts of a slice are joined with a
separator byte, one regex pass finds the words of all of them, the words' documents
are found in the offsets by ``searchsorted``, and n-grams whose first and last word
lie in different documents are masked out before ``bincount``.  Words of a slice are
handled in blocks, so that a very long text needs no list of all its words.

Null and empty texts, and texts without words, have no features: weight 0.  A null
doc_id hashes as the empty text and loses ties.  Repeated rows are rows of their
own.  Empty tables give no rows; an empty target has only the smoothing.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import islice
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, only, slices
from .ordering import numbered

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")       # of texts whose A-Z are lower case
SEPARATOR = b"\x00"                             # no word holds it
_BLOCK = 1 << 16                                # words handled at once


def features(texts: pa.Array, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (documents of the words, documents of the features, buckets of the
    features), documents as rows of ``texts``."""
    parts = [t.encode() if t else b"" for t in texts.to_pylist()]
    begin = np.cumsum([0, *(len(p) + len(SEPARATOR) for p in parts)])[:-1]
    found = WORD.finditer(SEPARATOR.join(parts).lower())
    kept_words: list[bytes] = []                # the last words of the block before
    kept_docs = np.zeros(0, np.int64)
    while block := list(islice(found, _BLOCK)):
        words = kept_words + [m.group() for m in block]
        own = np.searchsorted(begin, np.fromiter((m.start() for m in block), np.int64, len(block)), "right") - 1
        docs, old = np.concatenate([kept_docs, own]), len(kept_words)
        sums = [crc32(w) for w in words]
        where, codes = [own], [np.array(sums[old:], np.int64)]
        for k in range(2, most + 1):            # grams of k words that end at a word of this block
            last = range(max(k - 1, old), len(words))
            runs = (b" ".join(words[j - k + 1:j + 1]) for j in last)
            code = np.fromiter(map(crc32, runs), np.int64, len(last))
            at = np.arange(last.start, last.stop)
            inside = docs[at] == docs[at - k + 1]
            where.append(docs[at][inside])
            codes.append(code[inside])
        yield own, np.concatenate(where), np.concatenate(codes) % buckets
        tail = max(0, len(words) - (most - 1))
        kept_words, kept_docs = words[tail:], docs[tail:]


def bucket_counts(texts: DataFrame, most: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket: a row a task and bucket is summed in Spark;
    ``buckets`` numbers reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            for _, _, b in features(part.column(0), most, buckets):
                total += np.bincount(b, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = only(texts, text="string").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for b, n in rows.collect():
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) of the smoothed shares of each bucket, in doubles."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = gain.astype(np.float64)          # sums of whole numbers below 2**53 are exact
        for part in slices(batches, "text"):
            n = part.num_rows
            n_words, n_features, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            for words, where, bucket in features(part.column(1), most, len(gain)):
                n_words += np.bincount(words, minlength=n)
                n_features += np.bincount(where, minlength=n)
                total += np.bincount(where, weights=value[bucket], minlength=n)
            weight = total.astype(np.int64) // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank: 1, 2, 3 ... of
    those drawn, null of others.  Drawn are floor(percent N / 100) of the N documents
    of at least ``least_words`` words, highest scores first, ties to smaller doc_id.

    Scores are whole numbers of a bounded range, so counts by score say which score
    is the last that can be drawn; only documents from there on are ordered.
    """
    gain = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    draw = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = keep(weigh(docs, gain, most).withColumn("score", F.col("weight") + draw), "resample")
    judged = scored.where(F.col("n_words") >= least_words)
    by_score = sorted(judged.groupBy("score").count().collect(), reverse=True)
    wanted = sum(n for _, n in by_score) * percent // 100
    left, last = wanted, None
    for score, n in by_score:
        if left > 0:
            left, last = left - n, score
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    near = (F.col("n_words") >= least_words) & (F.col("score") >= last)
    ranked = numbered(scored.where(near).select(*columns), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "resample-rank")
    rank = F.when(F.col("position") < wanted, F.col("position") + 1)
    return (ranked.select(*columns, rank.alias("rank"))
            .unionByName(scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank"))))
