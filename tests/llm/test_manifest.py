import hashlib
import random
import zlib

import numpy as np
import pytest

from faclake.llm import manifest as M
from faclake.llm.common import keep
from faclake.session import ship_package

from .conftest import rows_of

DDL = "doc_id long, text string, lang string, source string, n_chars long, g string, at long, total int, node string, found int, leaf int"


def _frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    ship_package(spark)
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3, 4) for r in rows], DDL).repartition(3)


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def _levels(nodes, fan_out=8):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i:i + fan_out]) for i in range(0, len(out[-1]), fan_out)])
    return out


def _path(levels, at, fan_out=8):
    for level in levels[:-1]:
        run = at // fan_out * fan_out
        yield "".join(level[run:at]), "".join(level[at + 1:run + fan_out])
        at //= fan_out


def brute(rows, fan_out=8):
    groups = {}
    for row in rows:
        low = row[1]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and low is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in low)
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0, _leaf(row, row[1])), _leaf(row, low), row[0]))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:2])
        trees[name] = _levels([x[0][2] for x in groups[name]], fan_out)
    top = _levels([trees[name][-1][0] for name in names], fan_out)
    out = []
    for k, name in enumerate(names):
        for at, (key, found, doc_id) in enumerate(groups[name]):
            proof, now = "", found
            for a, z in [*_path(trees[name], at, fan_out), *_path(top, k, fan_out)]:
                proof, now = proof + a + z, _h(a, now, z)
            root = top[-1][0]
            out.append((doc_id, key[2], trees[name][-1][0], root, _h(proof), now, now == root))
    return sorted(out, key=repr)


def _rows(n, seed=3, langs=("en", "de", None, "", "é", "zz")):
    rng = random.Random(seed)
    ids = rng.sample(range(-5_000, 200_000), n)
    return [(i, rng.choice(["Ab c", "ab", "", None, f"Text {i} É"]), rng.choice(langs), rng.choice(["s", None]), rng.choice([None, i]))
            for i in ids]


def test_against_brute_force(spark):
    rows = _rows(700)
    rows += [(7_000_000_000_000_000_000, "Big", "en", "s", 3), (-9_000_000_000_000_000_000, "Small", "en", "s", 3)]
    rows += [(300_000 + i % 3, f"Twice {i}", "de", "s", i) for i in range(40)]            # ids that repeat
    rows += [(None, f"None {i}", lang, "s", i) for i in range(15) for lang in ("de", None)]
    rows += [(300_001, "same", "de", "s", 1)] * 90 + [(None, None, None, None, None)] * 20   # equal rows
    rows += [(400_000, "LONG " * 250_000, "en", "s", 9)]
    got = rows_of(M.manifest(_frame(spark, rows), M.tampered_text()))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 9, 64])
def test_sizes_of_trees(spark, n):
    rows = [(i * 3, "A", "en", "s", i) for i in range(n)] + ([(5, "A", "de", "s", 5)] if n == 9 else [])
    assert rows_of(M.manifest(_frame(spark, rows), M.tampered_text())) == brute(rows)


def test_untampered_rows_verify_and_fan_out(spark):
    rows = _rows(80)
    got = M.manifest(_frame(spark, rows), fan_out=3).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)
    assert {r["root"] for r in got} == {brute(rows, 3)[0][3]}


def test_more_groups_than_a_slot_array(spark):
    rows = [(i, "x", f"lang{i % 70}", "s", i) for i in range(150)]
    assert rows_of(M.manifest(_frame(spark, rows), M.tampered_text())) == brute(rows)


def test_empty_table(spark):
    got = M.manifest(_frame(spark, []), M.tampered_text())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0


def test_bitmaps_keep_ids_and_counts(spark):
    ids = [3, 3, 3, 1023, 1024, 5000, -1, *range(2048, 2148), 2100]
    rows = keep(_frame(spark, [(i, "x", "en", "s", 1) for i in ids]).selectExpr("concat('=', lang) g", "doc_id"), "t")
    seen = {}
    for r in M.bitmaps(rows, at_once=10).collect():
        low = np.flatnonzero(np.unpackbits(np.array(r["words"], "<i8").view(np.uint8), bitorder="little"))
        assert r["before"] == [int((low < 64 * k).sum()) for k in range(M._WORDS)]
        extra = dict(zip(r["again"], r["extra"]))
        for x in low.tolist():
            seen[(r["high"] << M._WIDTH) + x] = 1 + extra.get(x, 0)
        assert r["n"] == len(low) + sum(r["extra"])
    assert seen == {i: ids.count(i) for i in ids}


@pytest.mark.parametrize("low", [[], [0], [1023], list(range(0, 64, 2)), list(range(0, 66, 2)), list(range(1024))])
def test_packed_bits(low):
    data = M.pack_bits(np.array(low, np.int64))
    assert M.unpack_bits(data).tolist() == low and len(data) <= 128
