import glob
import io
import json
import zlib

import numpy as np
import pytest
import zstandard

from faclake.llm import token_files as T

from .conftest import rows_of
from .texts import corpus


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return model.encode(text or "", add_special_tokens=False).ids + [0]


def brute(rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = np.array(_ids(text), "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def test_query_against_brute_force(docs):
    rows = corpus(n=60) + [(500, "word and word " * 60_000), (501, "a <|endoftext|> b"), (502, "日本語 🙂 \x00\n")]
    assert rows_of(T.token_rows(docs(rows))) == brute(sorted(rows))


def test_repeated_and_missing_ids(docs):
    rows = [(None, "n"), (None, "n"), (None, None), (4, "same"), (4, "same"), (4, "other text"), (2, ""), (9, "z")]
    got = sorted(rows_of(T.token_rows(docs(rows))), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, None, 2, 4, 4, 4, 9]
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    assert sorted(r[3] for r in got) == sorted(r[3] for r in brute(rows))


def test_empty_table(docs):
    got = T.token_rows(docs([]))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0


def test_files_are_plain_zstandard_in_order(spark, docs, tmp):
    rows = corpus(n=40)
    T.write_tokens(docs(rows), f"{tmp}/t", files=3, file_bytes=2000, frame_ids=256)
    names = [f["name"] for f in json.load(open(f"{tmp}/t/{T.MANIFEST}"))["files"]]
    assert len(names) > 3 and len(glob.glob(f"{tmp}/t/part-*")) == len(names)
    ids = b""
    for name in names:
        with open(f"{tmp}/t/{name}", "rb") as f:
            ids += zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    want = [i for _, text in sorted(rows) for i in _ids(text)]
    assert np.frombuffer(ids, "<u4").tolist() == want


def test_filters_read_only_their_documents(spark, docs, tmp):
    rows = corpus(n=40)
    T.write_tokens(docs(rows), f"{tmp}/t", files=3, frame_ids=512)
    read = T.read_tokens(spark, f"{tmp}/t")
    few = read.where("doc_id IN (3, 30, 7777)")
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in few.collect()} == {i: _ids(rows[i][1]) for i in (3, 30)}
    assert read.where("doc_id = 7777").count() == 0 and read.where("doc_id = 7777").rdd.getNumPartitions() <= 1
    assert read.where("doc_id = 5 AND n_tokens > 0").count() == 1


def _file(sizes, frame_ids=8):
    out = io.BytesIO()
    writer = T.FrameWriter(out, frame_ids)
    for i, n in enumerate(sizes):
        writer.add(i if i % 4 else None, np.arange(n, dtype=np.uint32) + i)
    return out, writer.close()


def test_frames_of_requested_documents_only():
    sizes = [3, 30, 0, 1, 8, 8, 5, 200, 2]
    out, info = _file(sizes)
    assert info == {"docs": 9, "ids": sum(sizes), "nulls": 3, "least": 1, "most": 7}
    reader = T.FrameReader(out)
    for i, n in enumerate(sizes):
        reader.frames_read = 0
        (doc_id, start, length, pieces), = reader.documents(np.arange(9) == i)
        assert (start, length) == (sum(sizes[:i]), n) and doc_id == (i if i % 4 else None)
        assert np.frombuffer(b"".join(pieces), "<u4").tolist() == [i + k for k in range(n)]
        assert reader.frames_read <= n // 8 + 2
    reader.frames_read = 0
    assert [b"".join(p) for *_, p in reader.documents()] and reader.frames_read == -(-sum(sizes) // 8)


def test_a_frame_of_exactly_the_size_and_no_documents():
    for sizes in ([8], [16, 8], [0], []):
        out, _ = _file(sizes)
        assert [n for _, _, n, _ in T.FrameReader(out).documents()] == sizes


@pytest.mark.parametrize("at", [5, 40, 90, -3, -15, -30, -60])
def test_damage_is_found(at):
    out, _ = _file([5, 9, 30])
    data = bytearray(out.getvalue())
    data[at] ^= 0x55
    with pytest.raises(T.FormatError):
        for *_, pieces in T.FrameReader(io.BytesIO(bytes(data))).documents():
            b"".join(pieces)


@pytest.mark.parametrize("cut", [0, 5, 30, 100])
def test_cut_files_are_refused(cut):
    out, _ = _file([5, 9, 30])
    with pytest.raises(T.FormatError):
        T.FrameReader(io.BytesIO(out.getvalue()[:cut]))
