"""Toxicity: a counterfactually regularised text classifier.

A logistic model over the words of a text and their beginnings (hashed, counted
once per text).  It is trained on a bounded sample of labelled rows; beside the
log loss and an L1 term it pays for every change of its score when an identity
term of a labelled sentence is swapped for another of the same group, or, where
the sentence has none, put into it.  The model thus cannot lean on the bare
mention of a group.

Scores use the text only.  Null and empty texts get the score of the bias.
Labels that are null are ignored; of several labels of a doc_id the largest
counts.  Without labelled rows every score is 0, and if all labels are alike it
is their smoothed share.  Repeated rows score alike; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_BYTES, in_small_batches, only, per_row, slices, span_hashes, text_buffer, word_spans

# Swapped within a group; a parameter of fit().
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "flüchtlinge"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "refugiados"),
)
PREFIXES = (4, 5, 6)

_WORD = np.ones(256, bool)
_WORD[:0x80] = False
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 64-bit feature) of every word and word beginning, in any order."""
    data, off = text_buffer(column)
    start, end, first = word_spans(_WORD[data], off)
    low, row = _LOWER[data], per_row(first, len(start))
    rows, out = [row], [span_hashes(low, start, end)]
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        rows.append(row[long])
        out.append(span_hashes(low, start[long], start[long] + n) + np.uint64(n))
    return np.concatenate(rows), np.concatenate(out)


def matches(row: np.ndarray, f: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, index in ``known``) of the features that are in the
    sorted array ``known``."""
    if not len(known) or not len(f):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(1 << 16, bool)                       # most features are not known
    seen[known >> np.uint64(48)] = True
    some = np.flatnonzero(seen[f >> np.uint64(48)])
    at = np.minimum(np.searchsorted(known, f[some]), len(known) - 1)
    ok = known[at] == f[some]
    pair = np.unique(row[some[ok]] * len(known) + at[ok])
    return pair // len(known), pair % len(known)


@dataclass
class Model:
    known: np.ndarray           # sorted features
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        row, at = matches(*features(column), self.known)
        z = self.bias + np.bincount(row, self.weights[at], len(column))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def counterfactuals(texts: Sequence[str], groups=IDENTITY_GROUPS, seed: int = 7) -> list[tuple[str, str]]:
    """(sentence, changed sentence): each identity term of a sentence left out or
    swapped for another of its group, at all its places there, or a term put at
    the end of a sentence that has none."""
    return list(_counterfactuals(texts, groups, seed))


def _counterfactuals(texts: Sequence[str], groups=IDENTITY_GROUPS, seed: int = 7) -> Iterator[tuple[str, str]]:
    rng = np.random.default_rng(seed)
    group_of = {term: g for g in groups for term in g}
    any_term = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, sorted(group_of, key=len, reverse=True))) + r")(?!\w)", re.I)
    terms = sorted(group_of)
    for text in texts:
        for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
            if not sentence:
                continue
            places: dict[str, list] = {}
            for found in any_term.finditer(sentence):
                places.setdefault(found[1].lower(), []).append(found.span())
            for term, spans in places.items():
                kept = [sentence[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(sentence)])]
                for other in [*(t for t in group_of[term] if t != term), ""]:
                    yield sentence, other.join(kept)
            if not places:
                yield sentence, f"{sentence} {terms[rng.integers(len(terms))]}"


def _blocks(pairs: Iterator[tuple[str, str]], most: int = 1 << 19) -> Iterator[list[tuple[str, str]]]:
    """Pairs in lists of about ``most`` characters."""
    block, size = [], 0
    for pair in pairs:
        block.append(pair)
        size += len(pair[0]) + len(pair[1])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _changes(pairs: Iterator[tuple[str, str]], known: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of pairs, pair, index in ``known``, -1 or 1): the features that a
    change takes away or brings; pairs are made and matched in blocks."""
    n, rows, ats, vals = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for block in _blocks(pairs):
        sides = [matches(*features(pa.array([c[i] for c in block], pa.large_string())), known) for i in (0, 1)]
        ids = [r * len(known) + a for r, a in sides]
        for own, other, val in ((ids[0], ids[1], -1.0), (ids[1], ids[0], 1.0)):
            only_here = np.setdiff1d(own, other, assume_unique=True)   # what both have cancels out
            rows.append(only_here // max(1, len(known)) + n)
            ats.append(only_here % max(1, len(known)))
            vals.append(np.full(len(only_here), val))
        n += len(block)
    return n, np.concatenate(rows), np.concatenate(ats), np.concatenate(vals)


def train(texts: Sequence[str], labels: Sequence[int], groups=IDENTITY_GROUPS, fairness: float = 5.0,
          l1: float = 5e-4, steps: int = 300, keep: int = 1000, min_docs: int = 3) -> Model:
    """Accelerated proximal gradient on class-balanced log loss + ``l1`` +
    ``fairness`` times the mean squared score change of the counterfactuals.

    The weights are those of the ``keep`` features whose shares in the two
    classes differ most (two-proportion z value), and of the identity terms."""
    y = np.asarray(labels, float)
    none = np.zeros(0, np.uint64), np.zeros(0)
    if not len(y):
        return Model(*none, -700.0)
    if y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(*none, float(np.log(p / (1 - p))))
    own = [np.unique(features(pa.array([t], pa.large_string()))[1]) for t in texts]    # text by text: little memory
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    every, f = np.unique(np.concatenate(own), return_inverse=True)
    del own
    ones, count = np.bincount(f, y[row], len(every)), np.bincount(f, minlength=len(every))
    p, n1, n0 = count / len(y), y.sum(), (1 - y).sum()
    z = np.abs(ones / n1 - (count - ones) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[count < (min_docs if len(y) >= 200 else 1)] = 0
    terms = np.unique(features(pa.array([t for g in groups for t in g], pa.large_string()))[1])
    known = np.union1d(every[np.argsort(-z, kind="stable")[:keep]], terms[np.isin(terms, every)])
    changed, d_row, d_at, d_val = _changes(_counterfactuals(texts, groups), known)
    row, at = matches(row, every[f], known)
    n, m = len(y), len(known)
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n

    def gradient(w, b):
        z = np.bincount(row, w[at], n) + b
        g = share * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        out = np.bincount(at, g[row], m)
        if changed:
            d = np.bincount(d_row, d_val * w[d_at], changed)
            out += 2 * fairness / changed * np.bincount(d_at, d_val * d[d_row], m)
        return out, g.sum()

    # a step for each coordinate: its own curvature bound (rows share few features)
    width = np.bincount(row, minlength=n)
    bound = np.bincount(at, (share * width)[row], m) / 4 + 1e-9
    if changed:
        spread = np.bincount(d_row, np.abs(d_val), changed)
        bound += 2 * fairness / changed * np.bincount(d_at, spread[d_row], m)
    rate, b_rate = 1 / bound, 1 / (share * (width + 1)).sum() * 4
    w = last = np.zeros(m)
    b = b_last = 0.0
    for k in range(steps):
        v, vb = w + k / (k + 3) * (w - last), b + k / (k + 3) * (b - b_last)
        g, gb = gradient(v, vb)
        step = v - rate * g
        last, w = w, np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
        b_last, b = b, vb - b_rate * gb
    return Model(known[w != 0], w[w != 0], float(b))


def held_out(doc_id: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, sample_bytes: int = 1 << 16, **options) -> Model:
    """Train on at most ``sample_rows`` labelled rows outside the held-out part
    (half of each class, by hash of the id, as far as there are), whose texts
    have at most ``sample_bytes`` bytes."""
    own = (only(labels, doc_id="long", toxic="int").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
           .where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id", F.lit("toxicity")), "doc_id"]
    texts = only(docs, doc_id="long", text="string").where(F.octet_length("text") <= sample_bytes)
    rows = []
    for label in (1, 0):
        ids = own.where((F.col("toxic") == 1) if label else (F.col("toxic") != 1)).orderBy(*order).limit(sample_rows // 2)
        some = texts.join(F.broadcast(ids), "doc_id")          # at most sample_rows / 2 ids
        some = some.groupBy("doc_id").agg(F.min("text").alias("text"))      # of a repeated doc_id, always the same text
        rows += some.orderBy(*order).limit(sample_rows // 2).select("text", F.lit(label)).collect()
    return train([r[0] for r in rows], [r[1] for r in rows], **options)


SCHEMA = "doc_id long, score double, predicted int"


def score(docs: DataFrame, model: Model, threshold: float = 0.7, carry: str = "") -> DataFrame:
    """doc_id, held_out, score, predicted; ``carry`` as in decontamination."""
    extra = [c.strip().split(" ")[0] for c in carry.split(",") if c.strip()]
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most train's ``keep`` weights and the terms'

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASH_BYTES):
            p = shared.value.score(batch.column(1))
            columns = [batch.column(0).cast(pa.int64()), pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())]
            columns += [batch.column(batch.schema.get_field_index(c)) for c in extra]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", *extra])

    out = in_small_batches(docs).select("doc_id", "text", *[c for c in extra if c != "text"]).mapInArrow(run, SCHEMA + (f", {carry}" if carry else ""))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", *extra)
