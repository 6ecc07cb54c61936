"""N-gram Jaccard join: a size-aware heavy-light join.

A document's set holds the hashes of its distinct ``K``-word shingles (words:
runs of non-blank characters, A-Z lower-cased; fewer words: all of them as one
shingle).  Documents link when 100 * |x & y| >= ``PERCENT`` * |x | y|.

1. Equal sets are one class; its smallest doc_id stands for it from then on.
2. Shingles get one global order: by a count sketch of fixed size over all
   documents, rare ones first (any fixed order is exact; this one keeps common
   passages out of the prefixes).
3. Linked sets share ``c`` of the first n - ceil(n * PERCENT / 100) + c shingles.
   Small sets enumerate the 2-subsets of that prefix (c = 2); large sets, and the
   small ones that can link with them, scan inverted lists of its shingles
   (c = 1).  The boundary is the size at which the emitted rows cost least.
4. In each list every set is compared with one centre (the set that shares most),
   and links are contracted to components.  Only pairs of a list that are still
   in different components are then tested, block by block, by sizes and bitmaps
   that bound the symmetric difference; what these leave over is compared.  No
   list is expanded into rows of all its pairs.

Comparisons are of whole shingle sets, so components are exact (up to 64-bit
hash collisions inside a pair).

Null, empty or wordless texts have empty sets and link with nothing.  Rows that
repeat a doc_id with other texts are one document: their classes share a
component.  Rows without doc_id get no component.  An empty table gives no rows.
Texts are taken in slices, a very long one by itself and whole: its set is one row.
Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HASH_BYTES, drop, gram_hashes, in_small_batches, keep, mix, only, slices, span_hashes, text_buffer, word_spans

K = 5
PERCENT = 75
SHORT, BLOCK = 8, 2048               # members of a list that are paired directly, or compared at a time
CELL_BITS = 22                       # of the count sketch: 4M counters, whatever the input
_SLICE = 1 << 15
_LEAST_BITS, _MOST_BITS = 1 << 10, 1 << 17    # of the bitmaps, a power of two of about a set's size

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_sets(column: pa.Array, k: int = K) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, off = text_buffer(column)
    start, end, first = word_spans(_WORD[data], off)
    words = span_hashes(_LOWER[data], start, end)
    grams = gram_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        out.append(np.unique(grams[a:b - k + 1]) if b - a >= k else gram_hashes(words[a:b], b - a) if b > a else words[:0])
    return out


def needed(n):
    """ceil(n * PERCENT / 100): the least overlap of a set of size n with a linked one."""
    return (n * PERCENT + 99) // 100


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


_SETS = "doc_id long, n long, k1 long, k2 long, part int, slice int, counts binary"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and 128-bit key of each set; at the end the task's shingle counts."""
    part = TaskContext.get().partitionId()
    counts = np.zeros(1 << CELL_BITS, np.uint32)
    names = ["doc_id", "n", "k1", "k2", "part", "slice", "counts"]
    for batch in slices(batches, "text", HASH_BYTES):
        sets = shingle_sets(batch.column(1))
        every = np.concatenate(sets)
        np.add.at(counts, (every >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        other = mix(every ^ np.uint64(0x5851F42D4C957F2D))
        size = np.array([len(s) for s in sets])
        at = np.concatenate([[0], np.cumsum(size)])
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)]) for v in (every, other)]
        k1, k2 = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
        none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(k1), pa.array(k2), *none],
                                         names=names)
    if counts.any():
        rows = [(s, _pack(counts[a:a + _SLICE])) for s, a in enumerate(range(0, len(counts), _SLICE)) if counts[a:a + _SLICE].any()]
        for a in range(0, len(rows), 32):
            own = rows[a:a + 32]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(own), pa.int64())] * 4 + [pa.array([part] * len(own), pa.int32()), pa.array([r[0] for r in own], pa.int32()),
                                                        pa.array([r[1] for r in own], pa.binary())], names=names)


def _pack(counts: np.ndarray) -> bytes:
    """Counters as (place, count) pairs where few are set, else one after another."""
    at = np.flatnonzero(counts)
    if len(at) * 2 < len(counts):
        return b"s" + at.astype("<u2").tobytes() + counts[at].astype("<u4").tobytes()
    return b"d" + counts.astype("<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"d":
        return np.frombuffer(data, "<u4", offset=1)
    n = (len(data) - 1) // 6
    out = np.zeros(_SLICE, np.uint32)
    out[np.frombuffer(data, "<u2", n, 1)] = np.frombuffer(data, "<u4", n, 1 + 2 * n)
    return out


def _levels(rows: DataFrame, fan_in: int = 256) -> np.ndarray:
    """Rarity level of each sketch cell (one byte each): 0 up to twice the mean
    count, then one more for each doubling.  Counters are summed slice by slice,
    ``fan_in`` tasks at a time."""
    def total(table: pa.Table) -> pa.Table:
        out = np.zeros(_SLICE, np.uint64)
        for data in table.column("counts"):
            out += _unpack(data.as_py())
        return pa.table({"part": pa.array([table.column("part")[0].as_py() // fan_in], pa.int32()),
                         "slice": table.column("slice")[:1], "counts": pa.array([_pack(np.minimum(out, 0xFFFFFFFF))], pa.binary())})

    now, ddl = rows.select("part", "slice", "counts"), "part int, slice int, counts binary"
    top = now.agg(F.max("part")).first()[0]
    counts = np.zeros(1 << CELL_BITS, np.uint32)
    if top is not None:
        while True:
            now = now.groupBy("slice", F.expr(f"part div {fan_in}")).applyInArrow(total, ddl)
            top //= fan_in
            if top == 0:
                break
            now = keep(now, "jaccard-sketch")
        for r in now.toLocalIterator():                    # 2**CELL_BITS counters in all
            counts[r["slice"] * _SLICE:(r["slice"] + 1) * _SLICE] = _unpack(bytes(r["counts"]))
    ratio = counts / max(1.0, counts.mean() * 2)
    return np.where(ratio > 1, np.ceil(np.log2(np.maximum(ratio, 1))), 0).astype(np.uint8)


def boundary(sizes: list[tuple[int, int]], scan: float = 4.0, most: int = 64) -> int:
    """The size up to which sets enumerate 2-subsets: the one with the least cost
    over the (size, count) histogram, counting an emitted subset as 1 and an
    entry of an inverted list as ``scan`` (its row and the comparisons it starts).
    Beyond ``most`` the number of subsets always exceeds that."""
    prefix = lambda n: n - needed(n) + 1

    def cost(b: int) -> float:
        subsets = sum(c * (prefix(n) + 1) * prefix(n) / 2 for n, c in sizes if n <= b)
        return subsets + scan * sum(c * prefix(n) for n, c in sizes if n > b or n >= needed(b + 1))
    return min(range(0, most + 1), key=lambda b: (cost(b), b)) if sizes else 0


def signatures(s: np.ndarray, levels: np.ndarray, small: int) -> np.ndarray:
    """Hashes under which a set (sorted) is listed."""
    n = len(s)
    order = np.argsort(levels[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)], kind="stable")
    prefix = s[order[:n - needed(n) + 2]]
    out = []
    if 1 < n <= small:
        a, b = np.triu_indices(len(prefix), 1)
        out.append(mix(prefix[a] * np.uint64(0x9E3779B97F4A7C15) + mix(prefix[b])))
    if n > small or n >= needed(small + 1):
        out.append(prefix[:n - needed(n) + 1])
    return np.concatenate(out) if out else s[:0]


def _bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the counts of residues: two bitmaps differ in at most as many
    bits as their sets differ in shingles.  A longer bitmap folds to a shorter one
    by combining its halves."""
    size = min(max(_LEAST_BITS, 1 << (len(s) - 1).bit_length()), _MOST_BITS)
    bits = (np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _bits_apart(x: Column, y: Column) -> Column:
    """Number of bits in which two bitmaps (arrays of longs) differ.  The sets'
    sizes lie within a factor of two, so at most one fold makes them equal."""
    n = F.least(F.size(x), F.size(y))
    fold = lambda a: F.when(F.size(a) > n, F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, n + 1, n), lambda p, q: p.bitwiseXOR(q))).otherwise(a)
    return F.aggregate(F.zip_with(fold(x), fold(y), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda acc, c: acc + c)


def _candidates(table: pa.Table) -> pa.Table:
    """Of a list, or of two blocks of it, the pairs in different components that
    sizes and bitmaps leave over; each pair in the first of its common lists only,
    so that no pair comes out twice."""
    h, left, right = (table.column(c)[0].as_py() for c in ("h", "left", "right"))
    side, node, n, component = (table.column(c).to_numpy() for c in ("i", "node", "n", "component"))
    bits = [np.asarray(b.as_py(), np.int64).view(np.uint64) for b in table.column("bits")]
    size = np.array([len(b) for b in bits])
    out = []
    for width in np.unique(size):                      # pairs whose shorter bitmap has this width
        rows = np.flatnonzero((size == width) | (size == 2 * width))
        maps = np.stack([bits[r] if size[r] == width else bits[r][:width] ^ bits[r][width:] for r in rows])
        step = max(1, (1 << 22) // (len(rows) * int(width)))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            apart = np.bitwise_count(maps[at:at + step, None, :] ^ maps[None, :, :]).sum(axis=2, dtype=np.int64)
            x, y = part[:, None], rows[None, :]
            ok = (node[x] < node[y]) & (component[x] != component[y]) & (np.minimum(size[x], size[y]) == width)
            ok &= 100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y])
            ok &= apart * (100 + PERCENT) <= (n[x] + n[y]) * (100 - PERCENT)
            if left != right:
                ok &= side[x] != side[y]
            out += [(int(part[p]), int(rows[q])) for p, q in zip(*np.nonzero(ok))]
    lists = table.column("lists")
    first = [(a, b) for a, b in out if np.intersect1d(lists[a].values.to_numpy(), lists[b].values.to_numpy(), assume_unique=True)[0] == h]
    return pa.table({"a": pa.array([node[a] for a, _ in first], pa.int64()), "b": pa.array([node[b] for _, b in first], pa.int64())})


def _lister(levels, small: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASH_BYTES):
            sets = shingle_sets(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).to_pylist()
            out = [(i, len(s), int(s.sum(dtype=np.uint64).astype(np.int64)), signatures(s, levels.value, small).view(np.int64), _bitmap(s))
                   for i, s in zip(ids, sets) if len(s) and i is not None]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()),
                     pa.array([r[3] for r in out], pa.list_(pa.int64())), pa.array([r[4] for r in out], pa.list_(pa.int64()))],
                    names=["node", "n", "k1", "sigs", "bits"])
    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict = {}
    for batch in slices(batches, "text_b", HASH_BYTES):
        a, b = (batch.column(i).to_pylist() for i in (0, 1))
        cache = {k: v for k, v in cache.items() if k == a[0]}    # rows of one centre follow each other
        right = shingle_sets(batch.column(3))
        ok = []
        for i, node in enumerate(a):
            if node not in cache:
                cache[node] = shingle_sets(batch.column(2).slice(i, 1))[0]
            ok.append(_linked(cache[node], right[i]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable; nodes without edge are
    left out.  Minimum labels with pointer jumping; each round is written."""
    both = keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                  .select("node", F.least("node", "m").alias("component")), "jaccard-labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m")))
        step = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("component"))
        hop = step.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = keep(step.join(hop, "component", "left").select("node", "old", F.least("component", F.coalesce("up", "component")).alias("component")),
                   "jaccard-labels")
        labels = new.drop("old")
        if not new.where("component <> old").limit(1).count():
            return labels


def link(docs: DataFrame, broadcast_ids: int = 2_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    spark = docs.sparkSession
    texts = only(in_small_batches(docs), doc_id="long", text="string")
    scanned = keep(texts.mapInArrow(_scan, _SETS), "jaccard-sets")
    sets = scanned.where("part IS NULL").select("doc_id", "n", "k1", "k2")
    levels = spark.sparkContext.broadcast(_levels(scanned.where("part IS NOT NULL")))
    classes = keep(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("node")), "jaccard-classes")
    small = boundary([tuple(r) for r in classes.where("n <= 128").groupBy("n").count().collect()])   # at most 128 rows
    nodes = keep(texts.mapInArrow(_lister(levels, small), "node long, n long, k1 long, sigs array<long>, bits array<long>")
                 .join(classes.select("node", "k1", "n"), ["node", "k1", "n"], "left_semi"), "jaccard-nodes")

    # lists with more than one set, and in each the set that shares most
    entries = nodes.select("node", "n", F.explode("sigs").alias("h"))
    lists = entries.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo <> hi")
    lists = keep(lists.select("h", "c"), "jaccard-lists")
    members = keep(entries.join(lists, "h"), "jaccard-members")
    drop(lists)
    degree = members.groupBy("node").agg(F.sum("c").alias("degree"))
    ranked = keep(members.join(degree, "node").select("h", "node", "n", "degree"), "jaccard-ranked")
    drop(members)
    centre = ranked.groupBy("h").agg(F.max(F.struct("degree", (-F.col("node")).alias("neg"), "n")).alias("top"))
    star = (ranked.join(centre, "h").select("node", "n", (-F.col("top.neg")).alias("c"), F.col("top.n").alias("cn"))
            .where(f"node <> c AND 100 * least(n, cn) >= {PERCENT} * greatest(n, cn)").select(F.col("c").alias("a"), F.col("node").alias("b")))

    wanted = keep(ranked.select("node").distinct(), "jaccard-wanted")
    few = F.broadcast(wanted) if wanted.count() <= broadcast_ids else wanted       # 8 bytes an id
    listed = keep(texts.join(few, texts["doc_id"] == wanted["node"]).select("node", "text"), "jaccard-texts")

    bits = nodes.dropDuplicates(["node"]).select("node", "n", "bits")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The linked ones of the pairs (a, b): sizes and bitmaps rule most others
        out, then the whole sets are compared."""
        tested = pairs.distinct().join(bits.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa")), "a") \
            .join(bits.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb")), "b")
        # linked sets differ in at most (100 - PERCENT) / (100 + PERCENT) of their sizes' sum
        close = tested.where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)").where(
            _bits_apart(F.col("xa"), F.col("xb")) * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)).select("a", "b")
        close = keep(close, "jaccard-close")
        left, right = listed.select(F.col("node").alias("a"), F.col("text").alias("text_a")), listed.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return keep(close.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long"), name)

    same_id = sets.join(classes, ["k1", "k2", "n"]).groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("all")) \
        .where("size(all) > 1").select("a", F.explode("all").alias("b")).where("a <> b")
    edges = keep(verified(star, "jaccard-star").unionByName(same_id), "jaccard-edges")
    found = components(edges)

    # what the centres left apart: pairs of one list in different components
    own = F.coalesce("component", "node")
    split = keep(ranked.join(found, "node", "left").select("h", "node", "n", own.alias("component")), "jaccard-split")
    mixed = split.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
    apart = keep(split.join(mixed, "h"), "jaccard-apart")
    counts = apart.groupBy("h").agg(F.count(F.lit(1)).alias("members"))
    sized = keep(apart.join(counts, "h"), "jaccard-sized")
    drop(apart)
    # short lists: at most SHORT * (SHORT - 1) / 2 pairs each
    x, y = sized.where(f"members <= {SHORT}").alias("x"), sized.where(f"members <= {SHORT}").alias("y")
    short = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
                   ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    # longer ones in blocks of about BLOCK members, each pair of blocks a group
    long = sized.where(f"members > {SHORT}").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    own_lists = long.groupBy("node").agg(F.sort_array(F.collect_set("h")).alias("lists"))
    i, k = F.col("i"), F.col("k")
    dealt = (long.join(own_lists, "node").join(bits.select("node", "bits"), "node")
             .withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("h", F.least(i, k).alias("left"), F.greatest(i, k).alias("right"), "i", "node", "n", "component", "bits", "lists"))
    pairs = short.unionByName(dealt.groupBy("h", "left", "right").applyInArrow(_candidates, "a long, b long"))
    more = verified(pairs, "jaccard-more")
    if more.limit(1).count():
        found = components(edges.unionByName(more))

    node = classes.join(found, "node", "left").select("k1", "k2", "n", own.alias("component_id"))
    return sets.join(node, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
