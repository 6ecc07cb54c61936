import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from faclake.llm import jaccard as J

from .conftest import rows_of
from .texts import corpus

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d
    for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None], 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return sorted(((d, len(s), None if d is None else top(d)) for d, s in sets), key=repr)


def _near(seed, n, words, change):
    """Copies of one text, each with a share of its words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(max(0, round(words * change * rng.random()))):
            w[rng.randrange(words)] = f"z{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_equals_brute_force(docs):
    texts = _near(1, 25, 60, 0.05) + _near(2, 25, 12, 0.1) + _near(3, 20, 300, 0.06) + _near(4, 12, 6, 0.2)
    common = " ".join(f"c{i}" for i in range(40))
    rng = random.Random(9)
    texts += [f"{common} " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 40))) for _ in range(30)]
    rows = corpus(5) + [(1000 + i, t) for i, t in enumerate(texts)]
    rows += [(1000, texts[0]), (None, texts[0]), (None, None)]
    assert rows_of(J.link(docs(rows))) == brute(rows)


@pytest.mark.parametrize("short,block", [(2, 5), (8, 2048)])
def test_near_copies_far_from_every_centre(docs, monkeypatch, short, block):
    """Chains of copies that link with their neighbours, but not with one centre."""
    monkeypatch.setattr(J, "SHORT", short)
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(3)
    w = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(40):
        w[(7 * i) % 120] = f"z{i}"
        rows.append(((i * 17) % 40, " ".join(w)))
    rows += [(100 + i, t) for i, t in enumerate(_near(5, 30, 90, 0.12))]
    assert rows_of(J.link(docs(rows))) == brute(rows)


def test_a_repeated_id_joins_its_texts(docs):
    a, b = _near(6, 1, 30, 0)[0], _near(7, 1, 30, 0)[0]
    got = rows_of(J.link(docs([(5, a), (9, a), (9, b), (4, b)])))
    assert {r[2] for r in got} == {4}


def test_empty_and_wordless(docs):
    assert J.link(docs([])).collect() == []
    assert rows_of(J.link(docs([(2, ""), (1, None), (3, " \n")]))) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


@pytest.mark.parametrize("small", [0, 7, 20, 64])
def test_linked_sets_share_a_signature(small):
    rng, levels = np.random.default_rng(small), np.random.default_rng(1).integers(0, 3, 1 << J.CELL_BITS).astype(np.uint8)
    linked = 0
    for _ in range(3000):
        n = int(rng.integers(1, 45))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        if J._linked(x, y) and not np.array_equal(x, y):
            linked += 1
            assert np.intersect1d(J.signatures(x, levels, small), J.signatures(y, levels, small)).size
    assert linked > 300


def test_bitmaps_bound_the_difference(spark):
    rng = np.random.default_rng(3)
    pairs = []
    for n in (1, 5, 700, 1020, 1030, 2040, 2050, 5000):
        for share in (1.0, 0.95, 0.8, 0.5):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) < share], rng.integers(0, 1 << 63, n // 20 + 1, dtype=np.uint64)]))
            if 100 * min(len(x), len(y)) >= J.PERCENT * max(len(x), len(y)):
                pairs.append((len(np.setxor1d(x, y)), J._bitmap(x).tolist(), J._bitmap(y).tolist()))
    df = spark.createDataFrame(pairs, "apart int, x array<long>, y array<long>")
    rows = df.select("apart", J._bits_apart(F.col("x"), F.col("y")).alias("bits")).collect()
    assert all(r["bits"] <= r["apart"] for r in rows) and any(r["bits"] > 200 for r in rows)


def test_boundary_follows_cost():
    assert J.boundary([]) == 0
    assert J.boundary([(8, 1000)], scan=4) >= 8
    assert J.boundary([(60, 1000)], scan=4) < 60


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in J.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_sketch_packing():
    counts = np.zeros(J._SLICE, np.uint32)
    counts[[0, 5, J._SLICE - 1]] = [1, 70_000, 3]
    assert np.array_equal(J._unpack(J._pack(counts)), counts)
    dense = np.arange(J._SLICE, dtype=np.uint32)
    assert np.array_equal(J._unpack(J._pack(dense)), dense)
