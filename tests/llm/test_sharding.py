import collections
import zlib

import pytest

from faclake.llm import sharding as S

from .conftest import rows_of
from .texts import corpus


def test_law_slots_and_sizes(docs):
    rows = corpus(1, n=400) + [(None, "x"), (7, corpus(1, n=400)[7][1])]
    got = S.shard_documents(docs(rows), S.even_tree(40)).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    again = S.shard_documents(docs(rows[::-1]).repartition(5), S.even_tree(40)).collect()
    place = lambda x: sorted(((r["doc_id"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in x), key=repr)
    assert place(again) == place(got)


def _draw(key, level, child, weight):
    """Spark's chained xxhash64 of a long, a string and a long, as the tree draws."""
    import math

    import xxhash
    h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    h = xxhash.xxh64_intdigest(level.encode(), h)
    h = xxhash.xxh64_intdigest(int(child).to_bytes(4, "little", signed=True), h)
    return math.log(((h >> 11) + 0.5) / 2 ** 53) / weight


def brute(tree, key):
    node, rack_no = 0, 0
    regions = tree.regions
    pick = lambda level, node, ws: 0 if len(ws) == 1 else max(range(len(ws)), key=lambda i: (_draw(key, level, (node << 20) + i, ws[i]), -i))
    r = pick("region", 0, [sum(w for k in reg for _, w in k) for reg in regions])
    k = pick("rack", r, [sum(w for _, w in rack) for rack in regions[r]])
    rack_no = sum(len(reg) for reg in regions[:r]) + k
    return regions[r][k][pick("shard", rack_no, [w for _, w in regions[r][k]])][0]


def test_draws_equal_brute_force(docs):
    tree = S.Tree((((((0, 1.0), (1, 2.0)), ((2, 0.5),))), ((((3, 1.0), (4, 1.0), (5, 3.0)),))))
    got = S.shard_documents(docs([(i, "t") for i in range(500)]), tree).collect()
    assert {r["doc_id"]: r["shard"] for r in got} == {i: brute(tree, i) for i in range(500)}


def test_weights_set_shares_and_confine_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    light = S.Tree((((((0, 1.0), (1, 1.0)), ((2, 1.0), (3, 1.0)))), ((((4, 1.0), (5, 3.0)),))))
    heavy = S.Tree((((((0, 1.0), (1, 1.0)), ((2, 1.0), (3, 2.0)))), ((((4, 1.0), (5, 3.0)),))))
    both = S._place(S._place(ids, "doc_id", light, "a"), "doc_id", heavy, "b").collect()
    share = collections.Counter(r["a"] for r in both)
    assert all(abs(share[s] / 20_000 - w / 8) < 0.02 for s, w in ((0, 1), (2, 1), (4, 1), (5, 3)))
    moved = [(r["a"], r["b"]) for r in both if r["a"] != r["b"]]
    # shard 3 got heavier, and with it its rack and region: rows of the other region
    # only move into this region, rows of the other rack only into this rack
    assert moved and all(b < 4 for a, b in moved)
    assert all(b in (2, 3) for a, b in moved if a in (0, 1))
    assert all(b == 3 for a, b in moved if a in (2, 3))


def test_no_python_in_the_plan(docs):
    plan = S.shard_documents(docs([(1, "a")]), S.even_tree(40))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_trees():
    assert S.even_tree(41).shards == S.even_tree(40).grown().shards == list(range(41))
    for bad in ((), ((((0, 1.0), (0, 1.0)),),), ((((0, 0.0),),),)):
        with pytest.raises(ValueError):
            S.Tree(bad)


def test_empty_table(docs):
    assert S.shard_documents(docs([]), S.even_tree(3)).collect() == []
    assert rows_of(S.shard_documents(docs([(1, None)]), S.even_tree(1)).select("size", "text_crc32", "shard", "slot")) == [(16, 0, 0, 0)]


def test_growing_by_one_is_the_next_tree():
    for base in range(1, 61):
        for n in range(base, 62):
            assert S.even_tree(n, base).grown() == S.even_tree(n + 1, base)
        assert S.even_tree(base).shards == list(range(base))
    with pytest.raises(ValueError):
        S.even_tree(5, base=6)


def test_growing_past_ten_moves_rows_into_the_new_shard_only(spark):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    for n in (9, 19, 39, 49):
        both = S._place(S._place(ids, "doc_id", S.even_tree(n), "a"), "doc_id", S.even_tree(n + 1, base=n), "b").where("a <> b").collect()
        assert both and {r["b"] for r in both} == {n}


def test_a_hot_id_is_numbered_in_parts(spark, docs, capsys):
    rows = [(7, "same")] * 600 + [(None, None)] * 600 + [(i, "x") for i in range(100)]
    got = S.shard_documents(docs(rows).repartition(6), S.even_tree(40))
    by_shard = collections.defaultdict(list)
    for r in got.collect():
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and max(map(len, by_shard.values())) >= 600
    got.explain()
    assert "hashpartitioning(shard" in capsys.readouterr().out and "Python" not in capsys.readouterr().out
    assert S.shard_documents(docs([]), S.even_tree(3)).count() == 0
