"""Every stage of the corpus pipeline against a plain version of it."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as C
from faclake.llm import pii
from faclake.llm import toxicity as tox
from faclake.session import ship_package

from .texts import corpus

DDL = ("doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, component_id long, "
       "n_shingles long, contaminated boolean, spans string, redacted string, part long, ids string, held_out boolean")
LONG = "alpha beta gamma " * 60_000                       # 1 MB
BENCH = ["which of these nine rivers flows through the most countries on its way to the sea today",
         "short item here", "Ünïcode Wörds 12 34 five six seven eight nine ten eleven twelve thirteen fourteen", "", None]


def _rows():
    rng = random.Random(4)
    rows = [(i, t) for i, t in corpus(seed=3, n=90, words=(30, 90))]
    base = rows[0][1]
    for i in range(200, 230):                             # copies, near copies, and copies of copies
        words = base.split(" ")
        if i % 3:
            words[rng.randrange(len(words))] = f"other{i}"
        rows.append((i, " ".join(words)))
    rows += [(300, f"start {BENCH[0]} end"), (301, "x " * 400 + BENCH[0].upper()), (302, BENCH[1]), (303, f"{BENCH[2]}!"),
             (304, "which of these nine rivers flows through")]
    rows += [(400, "mail me at jo.doe@example.org or +1 (234) 555-0199, card 4111 1111 1111 1111, host 10.0.0.255"),
             (401, "no data 123 here"), (402, "a@b.c " * 50)]
    rows += [(500 + i, f"you are a vile rotten fool {i} and stupid") for i in range(40)]
    rows += [(600, LONG), (601, LONG), (700, None), (701, ""), (702, " \n"), (None, "no id at all here"), (None, "no id at all here"), (None, None)]
    rows += [(800, "repeated row of one document id"), (800, "repeated row of one document id")]
    return [(i, t, rng.choice(["en", None]), "s", None if t is None else len(t)) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ship_package(spark)
    path = str(tmp_path_factory.mktemp("pipeline"))
    labels = [(i, 1, int(500 <= i < 600)) for i in [*range(0, 60), *range(500, 540)]] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(BENCH)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    _frame(spark, _rows()).write.parquet(f"{path}/documents.parquet")
    return path


def _frame(spark, rows):
    extra = (0.5, 1, 2, 3, True, "s", "r", 4, "i", False)
    return spark.createDataFrame([(*r, *extra) for r in rows], DDL).repartition(3)


def _out(df):
    assert df.columns == C.COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _sorted(rows):
    return sorted(rows, key=repr)


def test_toxicity(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = tox.fit(C._documents(docs), spark.read.parquet(f"{folder}/labels.parquet"))
    weight = dict(zip(model.known.tolist(), model.weights.tolist()))

    def toxic(text):
        own = set(tox.features(pa.array([text], pa.large_string()))[1].tolist())
        z = model.bias + sum(weight.get(f, 0.0) for f in own)
        return 1 / (1 + np.exp(-z)) >= 0.7
    kept = [r for r in _rows() if not toxic(r[1])]
    assert _out(C.toxicity(spark, docs, folder)) == _sorted(kept)
    ids = {r[0] for r in kept}
    assert len(ids & set(range(500, 540))) <= 4 and len(ids & set(range(0, 60))) >= 58
    again = tox.fit(C._documents(docs).repartition(7), spark.read.parquet(f"{folder}/labels.parquet"))
    assert np.array_equal(model.known, again.known) and np.allclose(model.weights, again.weights)


def _shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _components(rows):
    sets = [(r[0], _shingles(r[1])) for r in rows]
    parent = {i: i for i, s in sets if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in parent}


def test_near_duplicates(spark, folder):
    rows = _rows()
    component = _components(rows)
    alone = [r for r in rows if r[0] is None or not re.search(r"[^\x20\x09-\x0D]", r[1] or "")]
    first = {}
    for r in rows:
        if r not in alone and component[r[0]] == r[0]:
            first[r[0]] = min(first.get(r[0], r), r, key=lambda x: (x[1], x[2] or ""))
    got = _out(C.near_duplicates(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder))
    want = _sorted([*first.values(), *alone])
    assert [r[:2] for r in got] == [r[:2] for r in want] and len(got) < len(rows) - 30


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_decontamination(spark, folder):
    windows = collections.defaultdict(set)
    for item in BENCH:
        w = _words(item)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[n].add(tuple(w[i:i + n]))

    def contaminated(text):
        w = _words(text)
        hit = {p for n, known in windows.items() for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in known for p in range(i, i + n)}
        return bool(hit) and 20 * len(hit) >= len(w)
    rows = _rows()
    kept = [r for r in rows if not contaminated(r[1])]
    assert {300, 302, 303} & {r[0] for r in kept} == set() and {301, 304, 600} <= {r[0] for r in kept}
    assert _out(C.decontamination(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)) == _sorted(kept)


def test_personal_data(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = pii.fit(C._documents(docs))
    want = []
    for doc_id, text, lang, source, n in _rows():
        base = pii.base_spans(text or "")
        spans = sorted([*base, *pii.added_spans(model, [text or ""], [base])[0]], key=lambda s: s[1])
        if spans:
            text = pii.redact(text, spans)
            n = len(text)
        want.append((doc_id, text, lang, source, n))
    got = _out(C.personal_data(spark, docs, folder))
    assert [r[0] for r in got] == [r[0] for r in _sorted(want)]
    assert [(r[0], r[1] or "", *r[2:]) for r in got] == [(r[0], r[1] or "", *r[2:]) for r in _sorted(want)]
    assert not any(pii.base_spans(r[1] or "") for r in got)


def test_packing(spark, folder):
    from faclake.llm import tokens
    rows = _rows()
    pieces = C.pack(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    sequences, own = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        own[p["doc_id"]].append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    ids = {i: [*tokens.encode(t, tokens.vocabulary()).tolist(), 0] for i, t, *_ in rows if i is not None and i != 800}
    for i, want in ids.items():
        got = sorted(own[i], key=lambda p: p["start"])
        assert [p["start"] for p in got] == np.cumsum([0, *(p["length"] for p in got)])[:-1].tolist()
        for p in got:
            part = np.array(want[p["start"]:p["start"] + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part) and p["doc_tokens"] == len(want)
        assert sum(p["length"] for p in got) == len(want)
    assert sum(p["length"] for p in own[800]) == 2 * own[800][0]["doc_tokens"] and len(own[None]) >= 3


@pytest.mark.parametrize("stage", [s for s in C.STAGES if s[0] != "packing"], ids=lambda s: s[0])
def test_empty_tables(spark, folder, stage):
    empty = _frame(spark, [])
    assert _out(stage[1](spark, empty, folder)) == []


def test_run_chains_the_stages_and_removes_what_it_wrote(spark, folder):
    import glob
    import os

    from faclake.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/faclake-llm/pipeline-*"))
    got = C.run(spark, folder)
    left = set(glob.glob(f"{root}/faclake-llm/pipeline-*")) - before
    assert [os.path.basename(x).split("-")[1] for x in left] == ["packing"]
    ids = {r["doc_id"] for r in got.select("doc_id").distinct().collect()}
    assert {700, 701, None, 401, 600} <= ids and not {302, 303, 601} & ids
    assert not ids & {i for i in range(200, 230) if i % 3 == 0}              # exact copies of document 0
    assert C.pack(spark, _frame(spark, []), folder).count() == 0
