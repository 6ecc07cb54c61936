import zlib

import numpy as np
import pytest

from faclake.llm import packing as P
from faclake.llm import tokens as T

from .conftest import rows_of
from .texts import corpus


def check(rows, got, size):
    import public_tokenizers
    json_form = public_tokenizers.path("byte_bpe_50k.json")
    want = sorted(((d, zlib.crc32(np.append(T.encode(t, json_form), 0).astype("<u4").tobytes())) for d, t in rows), key=repr)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    tokens = {}
    for d, t in rows:
        tokens.setdefault(d, []).append(np.append(T.encode(t, json_form), 0).astype("<u4"))
    assert set(by_doc) == {d for d, _ in want}
    for d, pieces in by_doc.items():
        if len(tokens[d]) == 1:                       # an id that repeats may have its pieces mixed
            ids, at = tokens[d][0], 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
        else:
            assert sum(p["length"] for p in pieces) == sum(len(x) for x in tokens[d])
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / max(1, total)


@pytest.mark.parametrize("windows,fan_in,size", [(64, 32, 1024), (2, 2, 64), (1, 2, 128)])
def test_every_id_in_one_piece_with_little_padding(docs, windows, fan_in, size):
    rows = corpus(8, n=150) + [(None, "no id"), (5, corpus(8, n=150)[5][1])]
    got = P.pack(docs(rows).repartition(7), size=size, windows=windows, fan_in=fan_in).collect()
    assert check(rows, got, size) < 0.02


def test_packer_keeps_its_bounds():
    rng = np.random.default_rng(3)
    p = P.Packer(256, 8, 16, 0)
    for i in range(2000):
        n = int(rng.integers(1, 700))
        p.add(i, 0, np.arange(n, dtype=np.uint32), n)
        assert len(p.open) == len(p.order) <= 8
    full = {}
    for r in p.done:
        full[r[5]] = full.get(r[5], 0) + r[2]
    assert min(full.values()) > 256 - 2 * 16


def test_empty_table(docs):
    assert P.pack(docs([])).collect() == []
    one = P.pack(docs([(1, None)])).collect()
    assert [(r["doc_id"], r["length"], r["doc_tokens"], r["offset"]) for r in one] == [(1, 1, 1, 0)]


def test_rank_form_gives_the_ids_of_the_vocabulary():
    import random

    import public_tokenizers
    rng = random.Random(3)
    parts = ["<|endoftext|>", "'s", "'ll", " ", "\n", "\t", "x", "é", "١", "²", "​", "語", "🙂", "12", "!!", "The"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(25))
        assert T.encode(text, T.vocabulary()).tolist() == T.encode(text, public_tokenizers.path("byte_bpe_50k.json")).tolist()
