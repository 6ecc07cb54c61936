import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from faclake.llm import resample as R
from faclake.session import ship_package

from .conftest import rows_of
from .texts import corpus

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _buckets(text, most, buckets):
    words = WORD.findall(_lower(text))
    return [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(words) - k + 1)], len(words)


def brute(docs, target, most=1, buckets=10_000, percent=10, least=20):
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in _buckets(text, most, buckets)[0]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        own, words = _buckets(text, most, buckets)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, words])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def _target(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id long, text string, n int")


TARGET = ["one two three", None, "", "ÀÉ abc def Abc", "long long " * 20]


@pytest.mark.parametrize("most,buckets", [(1, 10_000), (2, 50), (3, 997)])
def test_against_brute_force(spark, docs, most, buckets):
    rows = corpus(n=90) + [(-5, "Same words here " * 10)] * 40 + [(None, "word " * 30)] * 7 + [(500 + i, "tie " * 25) for i in range(30)]
    rows += [(900, "a b\x00c_d " * 60_000)]                       # more words than a block, other separators
    target = TARGET + [t for _, t in corpus(seed=1, n=12)]
    got = rows_of(R.resample(docs(rows), _target(spark, target), most, buckets, percent=35))
    assert got == brute(rows, target, most, buckets, percent=35)


def test_nothing_to_draw(spark, docs):
    rows = [(1, "few words"), (2, None), (3, "x " * 19)]
    got = rows_of(R.resample(docs(rows), _target(spark, TARGET)))
    assert got == brute(rows, TARGET) and all(r[4] is None for r in got)


def test_empty_tables(spark, docs):
    assert R.resample(docs([]), _target(spark, TARGET)).count() == 0
    rows = corpus(n=30)
    assert rows_of(R.resample(docs(rows), _target(spark, []))) == brute(rows, [])


def test_grams_never_cross_documents_or_blocks(monkeypatch):
    texts = ["a b c", "", "d", None, "e f g h", "x"]
    monkeypatch.setattr(R, "_BLOCK", 2)
    got = {i: [] for i in range(len(texts))}
    for _, where, bucket in R.features(pa.array(texts), 3, 1 << 32):
        for w, b in zip(where.tolist(), bucket.tolist()):
            got[w].append(b)
    assert {i: sorted(b) for i, b in got.items()} == {i: sorted(_buckets(t, 3, 1 << 32)[0]) for i, t in enumerate(texts)}


def test_ranks_are_dealt_over_partitions(spark, docs):
    """Numbers of a large group of equal rows come from many partitions."""
    ship_package(spark)
    from pyspark.sql import functions as F

    from faclake.llm.common import keep
    from faclake.llm.ordering import numbered
    rows = keep(docs([(1, "x")] * 3000 + [(i, "y") for i in range(50)]).select("doc_id", "text"), "t")
    got = numbered(rows, [F.col("doc_id").desc()], "t", partitions=6).withColumn("p", F.spark_partition_id())
    all_rows = got.collect()
    assert sorted(r["position"] for r in all_rows) == list(range(3050))
    order = [r["doc_id"] for r in sorted(all_rows, key=lambda r: r["position"])]
    assert order == sorted(order, reverse=True)
    files = {f for f in got.inputFiles()}
    assert len(files) >= 5
