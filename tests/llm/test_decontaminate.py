import hashlib
import random
import re

import pytest

from faclake.llm import decontaminate as D

from .conftest import rows_of
from .texts import corpus

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, span=13):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def _case(seed):
    rows, rng = corpus(seed), random.Random(seed)
    items = []
    for i in range(12):
        w = (rows[rng.randrange(60)][1] or "x").split()
        a = rng.randrange(len(w))
        items.append((i, " ".join(w[a:a + rng.choice([1, 2, 5, 12, 13, 14, 30])]).upper()))
    items += [(3, items[0][1]), (None, items[4][1]), (50, None), (51, ""), (52, "!?"), (53, items[0][1]), (54, "not in any text at all " * 4)]
    return rows + [(5, rows[5][1]), (None, rows[8][1])], items


@pytest.mark.parametrize("block_bytes,broadcast_bytes", [(1 << 20, 1 << 26), (50, 1 << 26), (1 << 20, 0), (200, 0)])
def test_equals_brute_force(spark, docs, block_bytes, broadcast_bytes):
    rows, items = _case(11)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int").coalesce(2)
    got = D.decontaminate(docs(rows), bench, block_bytes=block_bytes, broadcast_bytes=broadcast_bytes)
    assert rows_of(got) == brute(rows, items)


def test_carried_columns_beyond_the_broadcast(spark, docs):
    rows, items = _case(13)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [D.decontaminate(docs(rows), bench, broadcast_bytes=n, carry="text string, lang string, key string") for n in (1 << 26, 0)]
    assert got[0].columns == got[1].columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "text", "lang", "key"]
    assert rows_of(got[0]) == rows_of(got[1])


@pytest.mark.parametrize("broadcast_bytes", [1 << 28, 0])
def test_one_passage_in_many_items(spark, docs, broadcast_bytes):
    """Every document meets every item: pairs are taken in chunks."""
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(i, f"item{i} {passage} end{i}") for i in range(10_000)]
    rows = [(i, f"a{i} {passage} b" + (f" and {passage}" if i % 2 else "")) for i in range(6)] + [(9, "nothing here"), (10, None)]
    got = {r["doc_id"]: r for r in D.decontaminate(docs(rows), spark.createDataFrame(items, "item_id long, text string"),
                                                   broadcast_bytes=broadcast_bytes).collect()}
    ids = hashlib.sha256(",".join(sorted(str(i) for i in range(10_000))).encode()).hexdigest()
    assert all((got[i]["n_items"], got[i]["items_sha256"], got[i]["n_hit"]) == (10_000, ids, 14 * (1 + i % 2)) for i in range(6))
    assert not got[9]["contaminated"] and got[10]["n_words"] == 0


def test_range_chunks():
    import numpy as np
    lo, hi = np.array([3, 5, 5, 0]), np.array([6, 5, 9, 2])
    want = [(w, m) for w, (a, b) in enumerate(zip(lo, hi)) for m in range(a, b)]
    for most in (1, 2, 4, 100):
        got = [(int(w), int(m)) for which, at in D.range_chunks(lo, hi, most) for w, m in zip(which, at)]
        assert got == want
    assert list(D.range_chunks(lo[:0], hi[:0], 5)) == []


@pytest.mark.parametrize("k", [1, 4, 12])
def test_other_gram_sizes(spark, docs, k):
    rows, items = _case(12)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(D.decontaminate(docs(rows), bench, k=k)) == brute(rows, items)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs([]), bench).collect() == []
    assert {r["n_hit"] for r in D.decontaminate(docs(corpus(1)), bench).collect()} == {0}
