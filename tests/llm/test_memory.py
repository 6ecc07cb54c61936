"""What the stages of the pipeline take of an executor's memory beside its heap."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as C
from faclake.llm import jaccard, pii
from faclake.llm import toxicity as tox
from faclake.llm.common import BATCH_BYTES, HASH_BYTES, slices
from faclake.session import ship_package

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXT = "the quick brown fox writes 12 letters a day " * 60


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ship_package(spark)
    path = str(tmp_path_factory.mktemp("memory"))
    spark.createDataFrame([(i, 1, i % 2) for i in range(4)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "an item of the benchmark")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_a_stage_bounds_what_a_worker_is_handed(spark, folder, name):
    def largest(batches):
        yield pa.RecordBatch.from_pydict({"most": [max(b.nbytes for b in batches)]})

    docs = spark.range(4000, numPartitions=1).selectExpr("id AS doc_id", f"concat(id, '{TEXT}') AS text")    # 10 MB in one task
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "64m")
        dict(C.STAGES)[name](spark, docs.limit(3), folder)
        assert docs.mapInArrow(largest, "most long").first()[0] < 1.1 * BATCH_BYTES
        spark.conf.set(LIMIT, "64k")                       # a session's own lower bound stays
        dict(C.STAGES)[name](spark, docs.limit(3), folder)
        assert spark.conf.get(LIMIT) == "64k"
    finally:
        spark.conf.set(LIMIT, before)


def _peak(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_texts_are_hashed_in_small_slices():
    rows = pa.record_batch({"doc_id": pa.array(range(1600)), "text": pa.array([f"{i} {TEXT}" for i in range(1600)])})   # 4 MB
    levels = type("Held", (), {"value": np.zeros(1 << jaccard.CELL_BITS, np.uint8)})
    assert _peak(lambda: [0 for _ in jaccard._lister(levels, 8)(iter([rows]))]) < 12
    model = tox.train([TEXT, "some other words"], [0, 1])
    assert _peak(lambda: [model.score(b.column(1)) for b in slices(iter([rows]), "text", HASH_BYTES)]) < 12


def test_windows_enter_the_network_step_by_step():
    model = pii.Tagger.new(np.random.default_rng(1))
    model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    codes = np.random.default_rng(2).integers(0, pii._N_CHARS, (512, 96))
    whole = _peak(lambda: model.emissions(codes))
    assert whole < 25, whole


def test_one_centre_is_cut_once_over_all_slices(monkeypatch):
    cut = []
    real = jaccard.shingle_sets
    monkeypatch.setattr(jaccard, "shingle_sets", lambda column, k=jaccard.K: (cut.append(len(column)), real(column, k))[1])
    long = "one two three four five six seven eight nine ten " * 3000                   # 150 KB: two to a slice
    pairs = pa.record_batch({"a": pa.array([1] * 12), "b": pa.array(range(2, 14)), "text_a": pa.array([long] * 12), "text_b": pa.array([long] * 12)})
    found = pa.Table.from_batches(jaccard._verify(iter([pairs])))
    assert found.column("b").to_pylist() == list(range(2, 14)) and sum(cut) == 12 + 1
