import math
import random

import pytest

from faclake.llm import topk as T


def brute(rows, k, every):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, shard string")


@pytest.mark.parametrize("shard_rows,leaf", [(10_000, 8), (30, 4)])
def test_equals_brute_force(spark, shard_rows, leaf):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, [0.5, -0.25, 0.0, 0.125, 1.0, 0.0]) for i in range(60)]            # one common vector
    rows += [(300, None), (305, [float("nan")] * 6), (310, [None] * 6), (315, []), (320, []), (325, [1.0]), (330, [-3.0]),
             (None, [0.1] * 6), (40, rows[7][1]), (40, rows[9][1]), (335, [float("inf")] + [0.0] * 5)]
    got = sorted(tuple(r) for r in T.top_k(_frame(spark, rows), k=7, every=5, shard_rows=shard_rows, block=16, leaf=leaf).collect())
    assert got == brute(rows, 7, 5)


def test_large_values_stay_exact(spark):
    rows = [(i, [2.0 ** 24 + i, -(2.0 ** 23) - 3 * i]) for i in range(25)]
    got = sorted(tuple(r) for r in T.top_k(_frame(spark, rows), k=3, every=10).collect())
    assert got == brute(rows, 3, 10)


def test_few_rows(spark):
    assert T.top_k(_frame(spark, [])).collect() == []
    assert T.top_k(_frame(spark, [(20, [1.0])])).collect() == []
    assert [tuple(r) for r in T.top_k(_frame(spark, [(20, [1.0]), (21, [0.5])])).collect()] == [(20, 1, 21, 2048)]


def test_boxes_prune_what_cannot_win():
    """In few dimensions the bounds leave most leaves out, and lose nothing."""
    import numpy as np
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(0, 300, (4000, 2)))
    ids = rng.permutation(4000)
    tree = T.KDTree(ids, points, leaf=16)
    queries = points[:50]
    best = T.Best(ids[:50], 5)
    scored = T.search(tree, queries, best)
    leaves = int((tree.children[:, 0] < 0).sum())
    assert scored < 0.25 * 50 * leaves
    want = []
    for q, v in zip(ids[:50].tolist(), queries):
        s = sorted((-int(x), i) for i, x in zip(ids.tolist(), points @ v) if i != q)[:5]
        want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert sorted(best.rows()) == sorted(want)
