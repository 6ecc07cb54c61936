"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A document walks down region -> rack -> shard.  At each level every child draws
``ln(u) / weight`` with ``u`` in (0, 1) hashed from (doc_id, level, child) and
the largest draw wins (the smaller child on a tie), so a child gets a share
proportional to its weight and a changed weight moves rows only into or out of
the subtree whose weight changed.  A new shard opens a subtree of its own at
region level: rows move only into it.

Null doc_ids draw as one key.  Null texts have no bytes (size 16, crc 0).
Repeated rows are placed alike; each row gets its own slot.  Very long texts are
only measured.  An empty table
gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, only

_LEVELS = ("region", "rack", "shard")


@dataclass(frozen=True)
class Tree:
    """``regions[r][k]`` = tuple of (shard number, weight) of rack k in region r."""
    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    def __post_init__(self):
        ids = [s for r in self.regions for k in r for s, _ in k]
        if not ids or len(set(ids)) != len(ids):
            raise ValueError("a tree needs shards, each in one place")
        if any(not w > 0 for r in self.regions for k in r for _, w in k):
            raise ValueError("weights must be positive")

    @property
    def shards(self) -> list[int]:
        return sorted(s for r in self.regions for k in r for s, _ in k)

    def grown(self, weight: float = 1.0) -> "Tree":
        """One more shard, in a region and rack of its own."""
        return Tree(self.regions + ((((max(self.shards) + 1, weight),),),))


def even_tree(shards: int, base: int | None = None, racks: int = 2, per_rack: int = 5) -> Tree:
    """The tree of a store that began with ``base`` shards (default: that many) and
    grew one by one since: the first are dealt to whole regions of ``racks`` x
    ``per_rack`` shards, with a region of its own for each beyond the last whole one;
    every shard that came later is a region of its own, so ``even_tree(n + 1, base)``
    is ``even_tree(n, base).grown()`` for every n from ``base`` on, and growing never
    changes another subtree's weight."""
    base = shards if base is None else base
    if not 1 <= base <= shards:
        raise ValueError("a store begins with one shard at least, and only grows")
    size = racks * per_rack
    whole = base // size
    regions = [tuple(tuple((r * size + k * per_rack + i, 1.0) for i in range(per_rack)) for k in range(racks))
               for r in range(whole)]
    regions += [(((s, 1.0),),) for s in range(whole * size, shards)]
    return Tree(tuple(regions))


def _draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child), 11)
    return F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / weight


def _pick(key: Column, level: str, node: Column, sizes: list[int], weights: list[list[float]]) -> Column:
    """Index of the winning child of ``node`` (an index into sizes/weights)."""
    most = max(sizes)
    if most == 1:
        return F.lit(0)
    table = F.array(*[F.array(*[F.lit(float(w)) for w in ws]) for ws in weights])
    own = F.element_at(table, node + 1)
    draws = [F.when(F.size(own) > i, F.struct(_draw(key, level, node * F.lit(1 << 20) + F.lit(i), F.get(own, F.lit(i))).alias("d"),
                                              F.lit(-i).alias("c"))) for i in range(most)]
    return -(F.greatest(*draws)["c"] if most > 1 else draws[0]["c"])


def _place(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """Adds ``out``: the shard that ``tree`` gives the key."""
    k = F.col(key)
    racks = [rack for region in tree.regions for rack in region]
    first = [sum(len(r) for r in tree.regions[:i]) for i in range(len(tree.regions))]
    region_w = [sum(w for rack in region for _, w in rack) for region in tree.regions]
    ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
    df = df.withColumn("r__", _pick(k, _LEVELS[0], F.lit(0), [len(tree.regions)], [region_w]).cast("int"))
    rack = _pick(k, _LEVELS[1], F.col("r__"), [len(r) for r in tree.regions],
                 [[sum(w for _, w in rk) for rk in region] for region in tree.regions]).cast("int")
    df = df.withColumn("k__", F.element_at(ints(first), F.col("r__") + 1) + rack)
    leaf = _pick(k, _LEVELS[2], F.col("k__"), [len(rk) for rk in racks], [[w for _, w in rk] for rk in racks]).cast("int")
    start = [sum(len(rk) for rk in racks[:i]) for i in range(len(racks))]
    flat = ints(s for rk in racks for s, _ in rk)
    return df.withColumn(out, F.element_at(flat, F.element_at(ints(start), F.col("k__") + 1) + leaf + 1)).drop("r__", "k__")


def shard_documents(docs: DataFrame, tree: Tree) -> DataFrame:
    """Place every document; see the module's docstring.

    Slots: the placed rows, without texts, are written with the number of the scan
    partition they come from; rows are numbered within (shard, partition), and each
    partition's rows start where those of the partitions before it end.  So no task
    sees more of a shard than one partition has of it, whichever id or text is hot.
    """
    base = only(docs, doc_id="long", text="string")
    rows = base.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.spark_partition_id().alias("part"))
    rows = keep(_place(_place(rows, "doc_id", tree, "shard"), "doc_id", tree.grown(), "grown_shard"), "shards")
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))     # at most shards x partitions rows
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return (rows.withColumn("number", number).join(before, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("number") - 1).cast("long").alias("slot"), "grown_shard"))
