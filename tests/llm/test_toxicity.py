import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faclake.llm import toxicity as X

from .conftest import SF_ORACLE, rows_of
from .texts import corpus


def test_held_out_accuracy(spark, docs):
    docs([])                                               # ships the package
    table = lambda t: spark.read.parquet(f"{SF_ORACLE}/{t}.parquet")
    scored = X.score(table("documents"), X.fit(table("documents"), table("labels")))
    rows = scored.join(table("labels"), "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    yes, no = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in yes for b in no])
    assert auc > 0.9 and np.mean([s >= 0.7 for s in no]) < 0.03
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    for r in scored.select("doc_id", "held_out").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def _biased(n=600):
    """Toxic sentences mention one group far more often than harmless ones do."""
    rng = random.Random(1)
    lexicon = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 2
        words = [rng.choice(lexicon) for _ in range(12)]
        if rng.random() < (0.8 if toxic else 0.05):
            words.insert(rng.randrange(12), "immigrants")
        if toxic and rng.random() < 0.75:
            words.insert(rng.randrange(12), rng.choice(["vile", "dumb", "rotten"]))
        texts.append(" ".join(words) + ".")
        labels.append(toxic)
    return texts, labels


def test_counterfactuals_reduce_false_positives_on_mentions():
    texts, labels = _biased()
    neutral = pa.array([f"the {t} word{i} word{i + 1} visited the market." for i, t in enumerate(["immigrants"] * 40)])
    toxic = pa.array([f"the market is {t} word{i}." for i, t in enumerate(["vile", "dumb", "rotten"] * 10)])
    free, held = X.train(texts, labels, fairness=0.0), X.train(texts, labels)
    wrong = lambda m: float((m.score(neutral) >= 0.7).mean())
    assert wrong(free) > 0.9 and wrong(held) < 0.1
    assert (held.score(toxic) >= 0.7).mean() > 0.9


def test_counterfactual_pairs():
    pairs = X.counterfactuals(["The Muslims came. It rained."], groups=(("muslims", "jews", "hindus"),))
    assert ("The Muslims came.", "The jews came.") in pairs and ("The Muslims came.", "The  came.") in pairs
    assert any(a == "It rained." and b != a for a, b in pairs)


def test_counterfactuals_of_every_term_and_sentence():
    groups = (("muslims", "jews"), ("black", "white"), ("women", "men"))
    pairs = X.counterfactuals(["Muslims and black women came. It rained. It snowed."], groups=groups)
    first = "Muslims and black women came."
    changed = {b for a, b in pairs if a == first}
    assert changed == {"jews and black women came.", " and black women came.", "Muslims and white women came.",
                       "Muslims and  women came.", "Muslims and black men came.", "Muslims and black  came."}
    assert [sum(a == s for a, _ in pairs) for s in (first, "It rained.", "It snowed.")] == [6, 1, 1]
    assert {b for _, b in X.counterfactuals(["Women like women"], groups=groups)} == {"men like men", " like "}


def test_a_term_that_stands_second_is_regularised():
    texts, labels = _biased()
    second = [t.replace("immigrants", "women and immigrants") for t in texts]
    weight = lambda m: float(m.weights[np.isin(m.known, X.features(pa.array(["immigrants"]))[1])].sum())
    assert abs(weight(X.train(second, labels))) < 0.1 * abs(weight(X.train(second, labels, fairness=0.0)))


def test_odd_rows_and_labels(spark, docs):
    rows = corpus(6) + [(5, "again"), (None, "no id"), (5, "again")]
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(0, 60, 2)] + [(1, None, 1), (None, 1, 1), (3, 1, 0), (3, 0, 0), (999, 1, 1)],
                                   "doc_id long, toxic int, score int")
    got = X.score(docs(rows), X.fit(docs(rows), labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (60, 61, 64)}
    assert len(empty) == 1
    assert X.score(docs([]), X.fit(docs([]), labels)).collect() == []


@pytest.mark.parametrize("toxic,score", [([], 0.0), ([1, 1, 1], 0.8), ([0, 0], 0.25)])
def test_without_both_classes(spark, docs, toxic, score):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:len(toxic)]
    labels = spark.createDataFrame(list(zip(ids, toxic)), "doc_id long, toxic int")
    got = X.score(docs([(i, f"text {i}") for i in range(100)]), X.fit(docs([(i, f"text {i}") for i in range(100)]), labels))
    assert {round(r["score"], 6) for r in got.collect()} == {score}


def test_labels_and_held_out_rows_do_not_enter(spark, docs):
    rows = corpus(6)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    base = [(i, i % 2) for i, _ in rows if i not in held]
    make = lambda x: spark.createDataFrame(x, "doc_id long, toxic int")
    one = X.score(docs(rows), X.fit(docs(rows), make(base)))
    two = X.score(docs(rows).withColumn("lang", F.lit("zz")), X.fit(docs(rows), make(base + [(i, 1) for i in held])))
    assert rows_of(one) == rows_of(two)
