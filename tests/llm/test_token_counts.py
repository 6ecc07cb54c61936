import numpy as np
from pyspark.sql import functions as F

from faclake.llm import token_counts as C

from .conftest import rows_of
from .texts import corpus


def offsets(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).offsets


def brute(text, spans):
    counts, crossing, out = [0] * len(spans), [0] * len(spans), 0
    found = offsets(text) if text else []
    for a, b in found:
        own = [min(b, e) - max(a, s) for s, e in spans]
        if max(own, default=0) <= 0:
            out += 1
            continue
        k = own.index(max(own))
        counts[k] += 1
        crossing[k] += sum(o > 0 for o in own) > 1
    return counts, crossing, out, len(found)


def lines(text):
    spans, at = [], 0
    for part in text.split("\n"):
        spans.append((at, at + len(part) + 1))
        at += len(part) + 1
    spans[-1] = (spans[-1][0], len(text))
    return spans[:-1] if len(spans) > 1 and spans[-1][0] == len(text) else spans


def test_lines_equal_brute_force(docs):
    rows = corpus(4) + [(500, "a\n\n\nb c\n"), (501, "\n"), (502, "naïve 🙂🙂\nété\n\n  x"), (None, "no id\n"), (500, "a\n\n\nb c\n")]
    want = []
    for d, t in rows:
        spans = lines(t or "")
        counts, crossing, out, total = brute(t or "", spans)
        assert not out
        want += [(d, i, s, e, counts[i], crossing[i], total) for i, (s, e) in enumerate(spans)]
    got = rows_of(C.token_counts(docs(rows)))
    assert got == sorted(want, key=repr)


def test_given_sections(docs):
    rows = [(1, "hello wonderful world of tokens"), (2, None), (3, "abc")]
    sections = [(0, 7), (7, 20), (25, 31)]
    df = docs(rows).withColumn("own", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(
        F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in sections])))
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in C.token_counts(df, "own").collect()}
    counts, _, out, total = brute(rows[0][1], sections)
    assert [got[1, i] for i in range(3)] == counts and got.get((1, -1), 0) == out and sum(counts) + out == total
    assert got[2, 0] == 0 and (3, -1) in got


def test_ties_go_to_the_earlier_section():
    own, touched = C.attribute(np.array([0, 4]), np.array([4, 8]), np.array([0, 2, 5]), np.array([2, 5, 9]))
    assert own.tolist() == [0, 2] and touched.tolist() == [2, 2]


def test_empty_table(docs):
    assert C.token_counts(docs([])).collect() == []
