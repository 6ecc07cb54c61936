import hashlib
import random

import numpy as np
import pytest

from faclake.llm import suffix_dedup as S

from .conftest import rows_of
from .texts import corpus


def brute(rows, length):
    """rows: (doc_id, text); None ids come last, equal ids are one document."""
    order = lambda d: (d is None, d if d is not None else 0)
    seen = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w, at = b[i:i + length], (order(d), i)
            seen[w] = min(seen.get(w, at), at)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] != (order(d), i):
                gone[i:i + length] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most_strings", [30_000, 1])
def test_equals_brute_force(docs, most_strings):
    rows = corpus(2) + [(3, "a row that repeats an id " * 9), (3, corpus(2)[0][1]), (None, corpus(2)[0][1]), (None, "q" * 400), (7, corpus(2)[7][1])]
    got = S.remove_repeats(docs(rows), most_strings=most_strings, collection_bytes=5_000)
    assert rows_of(got) == brute(rows, 100)


def test_short_windows_and_kept_text(docs):
    rows = corpus(3, n=30, vocabulary=30)
    got = {r["doc_id"]: r for r in S.remove_repeats(docs(rows), length=24, gram=8, most_windows=16, spans=True).collect()}
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.values()), key=repr) == brute(rows, 24)
    for d, t in rows:
        b, at, left = (t or "").encode(), 0, b""
        for s in got[d]["spans"]:
            left, at = left + b[at:s["start"]], s["end"]
        assert left + b[at:] == bytes(got[d]["kept"])


def test_rows_without_id_are_told_apart(docs):
    """24 bits of a text hash would mix up some of these rows."""
    rng = random.Random(9)
    base = corpus(2, n=12)
    rows = [(None, " ".join(rng.choice("abcdefgh") * rng.randint(2, 9) for _ in range(25))) for _ in range(5000)]
    rows += [(None, t) for _, t in base] + [(d, t) for d, t in base] + [((1 << 63) - 1, "the largest id " * 20)]
    assert rows_of(S.remove_repeats(docs(rows))) == brute(rows, 100)


def test_empty_table(docs):
    assert S.remove_repeats(docs([])).collect() == []


def test_bwt_sorts_suffixes():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    size = np.array([len(s) for s in strings])
    bwt = S.ColumnBwt(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size, 6)
    suffixes = sorted((s[i:] + b"\0", k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    suffixes.sort(key=lambda x: (x[0], x[1]))              # ends sort by string, and before every symbol
    want = [strings[k][i - 1] if i else S._NONE for _, k, i in suffixes]
    assert bwt.symbols.tolist() == want
    common = [0]
    for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
        n = 0
        while n < min(len(a), len(b)) - 1 and a[n] == b[n]:
            n += 1
        common.append(min(n, 6))
    assert bwt.prefixes.tolist() == common
    string, offset, group = bwt.windows()
    classes = {}
    for s, o, g in zip(string, offset, group):
        classes.setdefault(g, set()).add(strings[s][o:o + 6])
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_rows_are_ordered_by_symbol_then_row():
    symbols = np.random.default_rng(3).integers(0, 256, 20_000).astype(np.uint8)
    for column in (symbols, symbols[:0], symbols[:1], np.full(9, S._NONE, np.uint8)):
        want = [r for r in np.argsort(column, kind="stable").tolist() if column[r] != S._NONE]
        assert S.ColumnBwt._sorted_rows(column).tolist() == want


@pytest.mark.parametrize("lengths", [[9, 1, 30, 4, 4, 17], [5] * 12])
def test_rounds_sort_no_column_and_carry_no_finished_string(monkeypatch, lengths):
    rng = random.Random(11)
    strings = [bytes(rng.choice(b"ab\xf4") for _ in range(n)) for n in lengths]
    size = np.array(lengths)
    sorts, widths, write = [], [], S.ColumnBwt._write
    monkeypatch.setattr(S.ColumnBwt, "_sorted_rows", staticmethod(lambda symbols: sorts.append(len(symbols))))
    monkeypatch.setattr(S.ColumnBwt, "_write", lambda self, *columns: (widths.append(len(columns[0])), write(self, *columns))[1])
    S.ColumnBwt(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size, 6)
    assert not sorts
    # after each round: the ends, and every string's symbols up to the round, counted from its first
    assert widths == [len(size) + int(np.maximum(size - left, 0).sum()) for left in range(max(lengths), -1, -1)]


def test_filter_of_shared_keys_keeps_them_and_drops_most_others(docs):
    spark = docs([]).sparkSession
    keys = np.random.default_rng(4).integers(0, 1 << 63, 30_000).astype(np.uint64)
    table = S._key_filter(spark.createDataFrame([(int(k),) for k in keys[:3000]], "key long"))
    assert S._may_hold(table, keys[:3000]).all() and S._may_hold(table, keys[3000:]).mean() < 0.07
    assert not S._may_hold(S._key_filter(spark.createDataFrame([], "key long")), keys).any()
    signed = np.array([-1, -(1 << 63), 5], np.int64)
    assert S._may_hold(S._key_filter(spark.createDataFrame([(int(k),) for k in signed], "key long")), signed.view(np.uint64)).all()
    small = S._key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), 1 << 15)
    assert len(small) == 4096 and S._may_hold(small, keys).all()
