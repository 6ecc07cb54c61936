"""Merkle manifest of a dataset: one tree per group (language), one root over the
groups.

A leaf is the SHA-256 of a row's fields.  The leaves of a group stand in ascending
doc_id order; every run of ``fan_out`` neighbours is hashed into one node, level by
level, until one is left, the group's subroot; the subroots, ordered by group, are
reduced in the same way to the root.

*Coordinates by bitmap rank.*  Each task turns its doc_ids into compressed bitmaps,
one per group and range of 1,024 ids (a sorted list of the set bits while they are
few, else the bits), and merged bitmaps get a popcount directory: bits set before
each 64-bit word, and before the bitmap in its group.  A leaf's coordinate is then a
look-up, directory plus popcount of the bits below its own; leaves are not sorted.
Ids that occur more than once are counted beside the bitmap, and their rows (and rows
without doc_id) are told apart by leaf, in an order that is made for them only.

*Levels by keyed slot arrays.*  Leaves meet under (group, coordinate div fan_out^2)
in arrays with a slot for each coordinate; an array is reduced by two levels at
once, and its node goes on to the next round with its own coordinate.  Proofs come
back down the same arrays: a node's path is its siblings in its array and the path
of the array's node.

Null fields hash as ``-``, so a null and an empty text differ.  Null doc_ids come
first in their group, equal doc_ids are ordered by leaf; equal rows have equal
leaves, whose places cannot be told apart.  An empty table has no rows.  A single
row is leaf, subroot and root at once, its proof is the hash of no siblings.  Very
long texts are hashed whole, in the JVM.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import islice
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, only
from .ordering import numbered

FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
_WIDTH = 10                    # a bitmap holds 2**10 ids
_WORDS = (1 << _WIDTH) // 64
_SPARSE = 32                   # up to so many ids a bitmap is their list (64 bytes; the bits take 128)
_LEVELS = 2                    # levels a slot array is reduced by

_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in fields.values()]), 256)


def tampered_text() -> Column:
    """The check of the registered query: rows whose doc_id has a CRC-32 that 3
    divides get their text in lower case (A-Z only)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", _A_Z, _a_z)).otherwise(F.col("text"))


def leaves(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """(g, doc_id, leaf, found): the group's key, never null; ``found`` is the leaf as it
    would be if the text were the column ``found``."""
    rows = only(docs, **FIELDS)
    own = {c: F.col(c) for c in FIELDS}
    other = F.col("leaf") if found is None else _leaf(own | {"text": F.col("text2")})
    rows = rows.withColumn("leaf", _leaf(own))
    if found is not None:
        rows = rows.withColumn("text2", found)
    group = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))   # null first
    return rows.select(group.alias("g"), "doc_id", "leaf", other.alias("found"))


# ---- compressed bitmaps -------------------------------------------------------

def pack_bits(low: np.ndarray) -> bytes:
    """Sorted distinct numbers below 2**_WIDTH."""
    if len(low) <= _SPARSE:
        return low.astype("<u2").tobytes()
    bits = np.zeros(1 << _WIDTH, np.uint8)
    bits[low] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(data: bytes) -> np.ndarray:
    if len(data) <= 2 * _SPARSE:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def _more(low: np.ndarray, extra: np.ndarray) -> bytes:
    """Ids that occur more than once: (number, occurrences beyond the first)."""
    return np.stack([low, extra], 1).astype("<i8").tobytes() if len(low) else b""


_PART = pa.schema([("g", pa.string()), ("high", pa.int64()), ("bits", pa.binary()), ("more", pa.binary())])
_longs = pa.list_(pa.int64())
_FULL = pa.schema([("g", pa.string()), ("high", pa.int64()), ("words", _longs), ("before", _longs), ("n", pa.int64()),
                   ("again", _longs), ("extra", _longs)])


def _own_bitmaps(g: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    """(g, high, bits, more) of the ids of every group."""
    for name, own in pd.Series(ids).groupby(g, sort=False):
        ids, n = np.unique(own.to_numpy(np.int64), return_counts=True)
        high = ids >> _WIDTH
        cut = np.flatnonzero(np.diff(high)) + 1
        for a, b in zip([0, *cut], [*cut, len(ids)]):
            low, count = ids[a:b] & ((1 << _WIDTH) - 1), n[a:b]
            again = count > 1
            yield name, int(high[a]), pack_bits(low), _more(low[again], count[again] - 1)


def _with_directory(key: tuple, total: np.ndarray) -> tuple:
    """A merged bitmap (occurrences by number) as a row of ``_FULL``."""
    low = np.flatnonzero(total)
    bits = np.zeros(1 << _WIDTH, np.uint8)
    bits[low] = 1
    per_word = np.bincount(low // 64, minlength=_WORDS)
    again = np.flatnonzero(total > 1)
    return (*key, np.packbits(bits, bitorder="little").view("<i8").tolist(), (np.cumsum(per_word) - per_word).tolist(),
            int(total.sum()), again.tolist(), (total[again] - 1).tolist())


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def bitmaps(rows: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """(g, high, words, before, n, again, extra) for all (g, doc_id) of ``rows``: the bits
    as 64-bit words, their popcount directory, the rows counted, and repeated ids.

    Each task makes bitmaps of the ids it reads, up to ``at_once`` of them together;
    those of one (g, high) meet in one task and are merged as they come, so a task
    holds one merged bitmap for each (g, high) it is dealt, however many parts there
    are."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held, n = [], 0
            for batch in batches:
                held.append(batch.to_pandas())
                n += batch.num_rows
                if n >= at_once:
                    whole = pd.concat(held)
                    yield from _own_bitmaps(whole["g"].to_numpy(), whole["doc_id"].to_numpy())
                    held, n = [], 0
            if n:
                whole = pd.concat(held)
                yield from _own_bitmaps(whole["g"].to_numpy(), whole["doc_id"].to_numpy())
        yield from _batches(rows(), _PART)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # key -> (the 128 bytes of bits, occurrences beyond the first of repeated numbers)
        have: dict[tuple, tuple[np.ndarray, dict[int, int]]] = {}
        for batch in batches:
            for g, high, bits, more in zip(*[c.to_pylist() for c in batch.columns]):
                low = unpack_bits(bits)
                mask, extra = have.setdefault((g, high), (np.zeros((1 << _WIDTH) // 8, np.uint8), {}))
                fresh = np.zeros(1 << _WIDTH, np.uint8)
                fresh[low] = 1
                fresh = np.packbits(fresh, bitorder="little")
                for x in np.flatnonzero(np.unpackbits(mask & fresh, bitorder="little")).tolist():
                    extra[x] = extra.get(x, 0) + 1
                for x, k in np.frombuffer(more, "<i8").reshape(-1, 2).tolist():
                    extra[x] = extra.get(x, 0) + k
                mask |= fresh

        def rows() -> Iterator[tuple]:
            for key, (mask, extra) in have.items():
                total = np.unpackbits(mask, bitorder="little").astype(np.int64)
                for x, k in extra.items():
                    total[x] += k
                yield _with_directory(key, total)
        yield from _batches(rows(), _FULL)

    known = rows.where("doc_id IS NOT NULL").select("g", "doc_id")
    parts = known.mapInArrow(local, "g string, high long, bits binary, more binary")
    return parts.repartition("g", "high").mapInArrow(
        merge, "g string, high long, words array<long>, before array<long>, n long, again array<long>, extra array<long>")


def directory(rows: DataFrame) -> DataFrame:
    """The bitmaps of ``rows`` with ``base``: rows of the group before the bitmap (those
    without doc_id first), and ``total``: rows of the group."""
    placed = numbered(keep(bitmaps(rows), "manifest-bitmaps"), [F.col("g").asc(), F.col("high").asc()], "manifest-directory")
    # running counts in blocks of 1,024 bitmaps, then of blocks
    placed = keep(placed.withColumn("block", F.floor(F.col("position") / 1024).cast("long")), "manifest-directory")
    inner = Window.partitionBy("g", "block").orderBy("position")
    placed = placed.withColumn("inner", F.sum("n").over(inner) - F.col("n"))
    blocks = placed.groupBy("g", "block").agg(F.sum("n").alias("n"))
    nulls = rows.where("doc_id IS NULL").groupBy("g").agg(F.count(F.lit(1)).alias("n")).select(
        "g", F.lit(-1).cast("long").alias("block"), "n")
    order = Window.partitionBy("g").orderBy("block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.unionByName(nulls).select("g", "block", (F.sum("n").over(order) - F.col("n")).alias("outer"),
                                              F.sum("n").over(whole).alias("total"))
    bits = placed.join(blocks, ["g", "block"]).select(
        "g", "high", "words", "before", "again", "extra", (F.col("inner") + F.col("outer")).alias("base"), "total")
    none = F.array().cast("array<long>")
    return bits.unionByName(blocks.where("block = -1").select(
        "g", F.lit(None).cast("long").alias("high"), none.alias("words"), none.alias("before"), none.alias("again"),
        none.alias("extra"), F.lit(0).cast("long").alias("base"), "total"))


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` (g, doc_id, leaf, found, from stored files) with ``at``, their place in
    the group, and ``total``, the group's rows."""
    high = F.shiftright("doc_id", _WIDTH)
    low = F.col("doc_id").bitwiseAND(F.lit((1 << _WIDTH) - 1)).cast("int")
    word, bit = F.shiftright(low, 6).cast("int"), low.bitwiseAND(F.lit(63))
    below = F.expr("~shiftleft(-1L, bit__)")
    rank = F.get("before", F.col("word__")) + F.bit_count(F.get("words", F.col("word__")).bitwiseAND(below))
    more = F.aggregate(F.zip_with("again", "extra", lambda a, e: F.when(a < F.col("low__"), e).otherwise(F.lit(0).cast("long"))),
                       F.lit(0).cast("long"), lambda x, y: x + y)
    at = F.coalesce(F.col("base") + rank + more, F.col("base"))
    several = F.col("doc_id").isNull() | F.array_contains("again", F.col("low__").cast("long"))
    keyed = rows.select("g", F.coalesce(high, F.lit(-(1 << 60)).cast("long")).alias("h__"), "doc_id", "leaf", "found",
                        low.alias("low__"), word.alias("word__"), bit.alias("bit__"))
    bits = directory(rows).withColumn("h__", F.coalesce("high", F.lit(-(1 << 60)).cast("long"))).drop("high")
    found = keep(keyed.join(bits.hint("shuffle_hash"), ["g", "h__"]).select(
        "g", "doc_id", "leaf", "found", at.alias("at"), "total", several.alias("several")), "manifest-leaves")
    again = found.where("several")
    if again.isEmpty():
        return found.drop("several")
    # rows that share a doc_id (or have none): by leaf, from the first place of their id
    placed = numbered(again, [F.col("g").asc(), F.col("at").asc(), F.col("leaf").asc()], "manifest-again")
    first = placed.groupBy("g", "at").agg(F.min("position").alias("first"))
    placed = placed.join(first, ["g", "at"]).withColumn("at", F.col("at") + F.col("position") - F.col("first"))
    columns = ["g", "doc_id", "leaf", "found", "at", "total"]
    return found.where("NOT several").select(*columns).unionByName(placed.select(*columns))


# ---- slot arrays ----------------------------------------------------------------

_SLOTS = "g string, at long, total long, slots array<long>, nodes array<string>, doc_ids array<long>, found array<string>, node string"


def reduced(nodes: list[str], total: int, fan_out: int) -> list[list[str]]:
    """The levels of a slot array, from its nodes up to ``_LEVELS`` levels higher, or as
    far as the tree of ``total`` nodes goes."""
    levels = [nodes]
    for _ in range(_LEVELS):
        if total <= 1:
            break
        last = levels[-1]
        levels.append([digest("".join(last[i:i + fan_out])) for i in range(0, len(last), fan_out)])
        total = -(-total // fan_out)
    return levels


def slot_arrays(nodes: DataFrame, fan_out: int) -> DataFrame:
    """Nodes (g, at, total, node, doc_id, found) meet in slot arrays under (g, at div
    fan_out^2); each array with the node it reduces to."""
    wide = fan_out ** _LEVELS

    def build(key: tuple, frame: pa.Table) -> pa.Table:
        frame = frame.take(pa.array(np.argsort(frame.column("at").to_numpy(), kind="stable")))
        total = frame.column("total")[0].as_py()
        own = frame.column("node").to_pylist()
        one = lambda v, t: pa.array([v], t)
        return pa.table({
            "g": one(key[0].as_py(), pa.string()), "at": one(key[1].as_py(), pa.int64()), "total": one(total, pa.int64()),
            "slots": one([a % wide for a in frame.column("at").to_pylist()], pa.list_(pa.int64())),
            "nodes": one(own, pa.list_(pa.string())), "doc_ids": one(frame.column("doc_id").to_pylist(), pa.list_(pa.int64())),
            "found": one(frame.column("found").to_pylist(), pa.list_(pa.string())),
            "node": one(reduced(own, total, fan_out)[-1][0], pa.string())})

    rows = nodes.select("g", F.expr(f"at div {wide}").alias("array"), "at", "total", "node", "doc_id", "found")
    return rows.groupBy("g", "array").applyInArrow(build, _SLOTS)


def _rounds(nodes: DataFrame, fan_out: int, name: str) -> list[DataFrame]:
    """Slot arrays of every round, written; the last round has one array a group."""
    most = nodes.agg(F.max("total")).first()[0]
    out = []
    while most is not None:
        out.append(keep(slot_arrays(nodes, fan_out), name))
        wide = fan_out ** _LEVELS
        most = -(-most // wide)
        if most <= 1:
            break
        nodes = out[-1].select("g", "at", F.expr(f"(total + {wide - 1}) div {wide}").alias("total"), "node",
                               F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("found"))
    return out


_PATH = "g string, at long, heads array<string>, tails array<string>, subroot string, root string"


def steps(levels: list[list[str]], slot: int, fan_out: int) -> tuple[list[str], list[str]]:
    """Siblings before and after the path from a slot up its array, level by level."""
    heads, tails = [], []
    for level in levels[:-1]:
        run = slot - slot % fan_out
        heads.append("".join(level[run:slot]))
        tails.append("".join(level[slot + 1:run + fan_out]))
        slot //= fan_out
    return heads, tails


def _down(arrays: DataFrame, paths: DataFrame, fan_out: int, rows: bool) -> DataFrame:
    """From the paths of arrays' nodes to those of what is in their slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in batch.to_pylist():
                wide, levels, out = fan_out ** _LEVELS, reduced(a["nodes"], a["total"], fan_out), []
                for k, slot in enumerate(a["slots"]):
                    heads, tails = steps(levels, slot, fan_out)
                    heads, tails = heads + a["heads"], tails + a["tails"]
                    if not rows:
                        out.append((a["g"], a["at"] * wide + slot, heads, tails, a["subroot"], a["root"]))
                        continue
                    now = a["found"][k]
                    for head, tail in zip(heads, tails):
                        now = digest(head + now + tail)
                    proof = hashlib.sha256("".join(h + t for h, t in zip(heads, tails)).encode()).hexdigest()
                    out.append((a["doc_ids"][k], a["nodes"][k], a["subroot"], a["root"], proof, now, now == a["root"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    text, texts = pa.string(), pa.list_(pa.string())
    if rows:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        types, ddl = [pa.int64(), text, text, text, text, text, pa.bool_()], (
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    else:
        names, types, ddl = ["g", "at", "heads", "tails", "subroot", "root"], [text, pa.int64(), texts, texts, text, text], _PATH
    # a lone node has no path of its own: its slot is the array's node
    return arrays.join(paths, ["g", "at"]).mapInArrow(run, ddl)


def tree(rows: DataFrame, fan_out: int = 8) -> tuple[list[DataFrame], list[DataFrame]]:
    """Slot arrays of the groups' trees and of the tree over their subroots."""
    inner = _rounds(coordinates(rows).withColumnRenamed("leaf", "node"), fan_out, "manifest-slots")
    if not inner:
        return [], []
    subroots = keep(inner[-1].select("g", "node"), "manifest-subroots")
    n = subroots.count()
    order = numbered(subroots, [F.col("g").asc()], "manifest-groups")
    top = order.select(F.lit("").alias("g"), F.col("position").alias("at"), F.lit(n).cast("long").alias("total"), "node",
                       F.lit(None).cast("long").alias("doc_id"), F.col("g").alias("found"))
    return inner, _rounds(top, fan_out, "manifest-top")


def manifest(docs: DataFrame, found: Column | None = None, fan_out: int = 8) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of the siblings on its path,
    left to right, level by level), folded_root and verified: the root that the row's
    text as ``found`` (a column; default: as it is) leads to, and whether it is the
    root."""
    rows = keep(leaves(docs, found), "manifest-rows")
    inner, top = tree(rows, fan_out)
    spark = docs.sparkSession
    if not inner:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    none = F.array().cast("array<string>")
    paths = top[-1].select("g", "at", none.alias("heads"), none.alias("tails"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for arrays in reversed(top):
        paths = keep(_down(arrays, paths, fan_out, rows=False), "manifest-paths")
    # slot of the top tree -> group and its subroot
    groups = top[0].select("at", F.explode(F.arrays_zip("slots", "nodes", "found")).alias("x")).select(
        (F.col("at") * fan_out ** _LEVELS + F.col("x.slots")).alias("at"), F.col("x.found").alias("g"), F.col("x.nodes").alias("subroot"))
    paths = paths.drop("g", "subroot").join(groups, "at").select(
        "g", F.lit(0).cast("long").alias("at"), "heads", "tails", "subroot", "root")
    for arrays in reversed(inner[1:]):
        paths = keep(_down(arrays, paths, fan_out, rows=False), "manifest-paths")
    return _down(inner[0], paths, fan_out, rows=True)
