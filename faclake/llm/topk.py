"""Exact top-k search by inner product with a KD-tree per shard.

Vectors become integers floor(scale * x).  The candidates are dealt to shards
by a hash of their id; each shard (of at most ``shard_rows`` rows) builds a
KD-tree: median splits along the widest side down to small leaves, each node
with the tight bounding box of its points and its smallest id.  Queries come in
blocks.  A task takes one block through the shards one after another: nodes are
visited best first by the largest inner product their box allows, once for all
queries of the block that the node may still serve, with one matrix product a leaf.
Each query's k-th best score found so far is carried from shard to shard and prunes
every node whose bound is below it, or equal to it with no id that would win the tie.

Scores are exact: float64 products while every partial sum stays below 2**53,
Python integers beyond.  Vectors that are null, or hold null or non-finite
components, take no part; only vectors of the same length are compared, and
empty vectors score 0.  Ties go to the smaller id, then the ids of equal rows
repeat.  A query's candidates are all rows with another id.  A query id that
repeats is answered for each of its rows; null ids take no part.  An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

SCHEMA = "query_id long, rank int, vec_id long, score long"
_EXACT = float(1 << 53)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest integer type that holds them."""
    if values.size and values.dtype != object and float(np.abs(values).max()) < _EXACT:
        for kind in (np.int8, np.int16, np.int32, np.int64):
            if np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
                return values.astype(kind)
    return values


class KDTree:
    """Arrays of a tree over integer points of one length."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = 64):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        rows = np.arange(len(ids))
        spans, children, low, high, first = [], [], [], [], []
        perm = rows.copy()
        todo = [(0, len(ids), None)]
        while todo:
            a, b, parent = todo.pop()
            here = len(spans)
            part = self.points[perm[a:b]]
            spans.append((a, b))
            children.append([-1, -1])
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            first.append(self.ids[perm[a:b]].min())
            if parent is not None:
                children[parent][0 if children[parent][0] < 0 else 1] = here
            if b - a > leaf and part.shape[1]:
                side = int(np.argmax(high[-1].astype(float) - low[-1]))
                if high[-1][side] > low[-1][side]:            # equal points stay one leaf
                    middle = (b - a) // 2
                    perm[a:b] = perm[a:b][np.argpartition(part[:, side], middle, kind="introselect")]
                    todo += [(a + middle, b, here), (a, a + middle, here)]
        self.ids, self.points = self.ids[perm], self.points[perm]
        self.spans, self.children = np.array(spans), np.array(children)
        self.low, self.high, self.first = np.array(low), np.array(high), np.array(first)

    def to_bytes(self) -> bytes:
        return pickle.dumps({k: narrow(v) for k, v in vars(self).items()}, pickle.HIGHEST_PROTOCOL)

    @classmethod
    def from_bytes(cls, data: bytes) -> "KDTree":
        tree = cls.__new__(cls)
        vars(tree).update(pickle.loads(data))
        return tree

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


class Best:
    """The k best (score, id) of every query of a block, best first, and candidates
    that are not sorted in yet.  Missing ones score -inf."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids.astype(np.int64), k
        self.scores = np.full((len(query_ids), k), -np.inf)
        self.ids = np.full((len(query_ids), k), np.iinfo(np.int64).max)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def may_win(self, rows: np.ndarray, bound: np.ndarray, smallest_id) -> np.ndarray:
        """Could something of at most ``bound`` and at least ``smallest_id`` enter?"""
        kth = self.scores[rows, -1]
        return ((bound > kth) | ((bound == kth) & (smallest_id < self.ids[rows, -1]))).astype(bool)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores[i, j]``: of candidate i for query ``rows[j]``."""
        ok = self.may_win(rows[None, :], scores, ids[:, None]) & (ids[:, None] != self.query_ids[rows][None, :])
        at, col = np.nonzero(ok)
        if len(at):
            self.waiting.append((rows[col], scores[at, col], ids[at]))
            if sum(len(w[0]) for w in self.waiting) > 8192:
                self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        row, score, vec = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting = []
        some = np.unique(row)
        row = np.concatenate([np.repeat(some, self.k), row])
        score = np.concatenate([self.scores[some].ravel(), score])
        vec = np.concatenate([self.ids[some].ravel(), vec])
        order = np.lexsort((vec, -score, row))
        row, score, vec = row[order], score[order], vec[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        keep = nth < self.k
        self.scores = self.scores.astype(score.dtype, copy=False)
        self.scores[row[keep], nth[keep]], self.ids[row[keep], nth[keep]] = score[keep], vec[keep]

    def rows(self) -> list[tuple]:
        self.settle()
        return [(int(q), r + 1, int(i), int(s)) for q, ids, scores in zip(self.query_ids, self.ids, self.scores)
                for r, (i, s) in enumerate(zip(ids, scores)) if s != -np.inf]


def search(tree: KDTree, queries: np.ndarray, best: Best) -> int:
    """Best-first traversal of one shard by all queries of a block together: a node is
    visited once, for those queries whose k-th score its box can still beat.  Returns
    the number of (query, leaf) pairs scored."""
    bound, inner, scored = tree.bounds(queries), tree.children[:, 0] >= 0, 0
    every = np.arange(len(queries))
    todo = [(-bound[:, 0].max(), 0, every)]
    while todo:
        _, node, rows = heapq.heappop(todo)
        rows = rows[best.may_win(rows, bound[rows, node], tree.first[node])]
        if not len(rows):
            continue
        if inner[node]:
            for child in tree.children[node]:
                live = rows[best.may_win(rows, bound[rows, child], tree.first[child])]
                if len(live):
                    heapq.heappush(todo, (-bound[live, child].max(), int(child), live))
            continue
        a, b = tree.spans[node]
        scored += len(rows)
        best.offer(rows, tree.ids[a:b], tree.points[a:b] @ queries[rows].T)
    best.settle()
    return scored


def _integers(column: pa.Array, scale: int) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector, None where it takes no part.  Values of
    2**53 and more become Python integers."""
    column = column.cast(pa.list_(pa.float64()))
    off, flat = column.offsets.to_numpy(), column.values
    lost = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))]) if flat.null_count else None
    values = np.floor(flat.to_numpy(zero_copy_only=False) * float(scale)) if len(flat) else np.zeros(0)
    out: list[np.ndarray | None] = []
    for i, ok in enumerate(column.is_valid().to_pylist()):
        a, b = off[i], off[i + 1]
        v = values[a:b]
        out.append(v if ok and (lost is None or lost[a] == lost[b]) and np.isfinite(v).all() else None)
    return out


def _exact(tree: KDTree, queries: np.ndarray) -> np.ndarray:
    """Queries, and the tree's numbers, in a type whose products are exact."""
    top = max([0.0, *(float(np.abs(x).max()) for x in (tree.points, queries) if x.size)])
    if top * top * max(1, queries.shape[1]) < _EXACT:
        whole = lambda x: x.astype(np.float64)
    else:
        whole = np.frompyfunc(int, 1, 1)
    tree.points, tree.low, tree.high = whole(tree.points), whole(tree.low), whole(tree.high)
    return whole(queries)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, shard_rows: int = 20_000,
          block: int = 512, leaf: int = 64) -> DataFrame:
    """Queries: rows whose id is divisible by ``every``; see the docstring above.

    Shards and blocks are packed into one binary row each and written to the
    shared scratch folder; a task holds one block and one shard at a time.
    """
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
                          ).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    counts = base.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block))

    def packed(part: str, blob):
        def run(table: pa.Table) -> pa.Table:
            ids = table.column("vec_id").to_numpy()
            got = _integers(table.column("embedding").combine_chunks(), scale)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(got):
                if v is not None:
                    by_size.setdefault(len(v), []).append(i)
            out = [(table.column(part)[0].as_py(), size, blob(ids[rows], np.stack([got[i] for i in rows])))
                   for size, rows in by_size.items()]
            return pa.table({part: pa.array([r[0] for r in out], pa.int32()), "size": pa.array([r[1] for r in out], pa.int32()),
                             f"{part}_blob": pa.array([r[2] for r in out], pa.binary())})
        return run

    def blobs(df: DataFrame, part: str, parts: int, blob) -> DataFrame:
        # a row's place depends on all of it, so rows that repeat an id spread out
        dealt = df.withColumn(part, F.pmod(F.xxhash64("vec_id", "embedding", F.lit(part)), F.lit(parts)).cast("int"))
        return keep(dealt.groupBy(part).applyInArrow(packed(part, blob), f"{part} int, size int, {part}_blob binary"), f"topk-{part}")

    shard = blobs(base, "shard", shards, lambda ids, points: KDTree(ids, narrow(points), leaf).to_bytes())
    query = blobs(base.where(F.col("vec_id") % every == 0), "block", blocks,
                  lambda ids, points: pickle.dumps((ids, narrow(points)), pickle.HIGHEST_PROTOCOL))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, queries = None, None, None

        def results() -> pa.RecordBatch:
            cols = list(zip(*best.rows())) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if now != (r["block"], r["size"]):
                    if best is not None:
                        yield results()
                    now = (r["block"], r["size"])
                    ids, queries = pickle.loads(r["block_blob"])
                    best = Best(ids, k)
                tree = KDTree.from_bytes(r["shard_blob"])
                search(tree, _exact(tree, queries), best)
        if best is not None:
            yield results()

    # a stated query set in blocks against all shards: each pair of blobs meets once
    pairs = (query.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(shard, ["shard", "size"])
             .select("block", "size", "shard", "block_blob", "shard_blob"))
    return pairs.repartition("block", "size").sortWithinPartitions("block", "size", "shard").mapInArrow(answer, SCHEMA)
