import hashlib
import random
import re

import numpy as np
import pytest

from faclake.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda t: [int(c) for c in t if c in "0123456789"]

    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(d[::-1])) % 10 == 0
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    parts = list("0123459.@+- ()aZ%_é\n") + ["a@b.c", "@x.y", "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "255.256.1.1", "+1 (234) 555-0199",
                                              "00000000255.1.1.1", "..", "--", "+12345678"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 400_000 + "@", "9" * 400_000, "1." * 200_000, "+1" + "(" * 200_000, "a@" * 100_000, "+1" * 100_000):
        P.base_spans(text)


def _texts(n, seed):
    rng, r = random.Random(seed), np.random.default_rng(seed)
    lexicon = ["".join(rng.choice("aeilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    words = lambda k: " ".join(rng.choice(lexicon) for _ in range(k))
    seeds = ["+1 (456) 555-2186", "abc.67@mail6.example.com", "10.20.30.40", "4111111111111111"]
    kinds = ["phone", "email", "ip", "card"]
    out = []
    for i in range(n):
        value = P._respell(kinds[i % 4], seeds[i % 4], type("R", (), {"integers": lambda self, *a: 0 if a == (4,) else r.integers(*a)})())
        out.append(f"{words(30)} {value} {words(30)}")
    return out


@pytest.fixture(scope="module")
def model():
    return P.train(_texts(200, 1))


def test_gradient():
    rng = np.random.default_rng(0)
    m = P.Tagger.new(rng, 4, 3)
    codes, tags = rng.integers(0, 97, (3, 7)), np.array([[0, 1, 2, 0, 3, 4, 4], [0] * 7, [5, 6, 0, 7, 8, 0, 0]])
    _, g = m.gradient(codes, tags)
    for k in m.p:
        for _ in range(5):
            at = tuple(int(rng.integers(0, s)) for s in m.p[k].shape)
            if k == "t" and P._FORBIDDEN[at]:
                continue
            keep = m.p[k][at]
            m.p[k][at] = keep + 1e-5
            up = m.gradient(codes, tags)[0]
            m.p[k][at] = keep - 1e-5
            down = m.gradient(codes, tags)[0]
            m.p[k][at] = keep
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6


def test_tagger_on_unseen_texts(model):
    texts = _texts(120, 2)
    base = [P.base_spans(t) for t in texts]
    found = P.added_spans(model, texts, [[] for _ in texts])
    right = sum(len(set(a) & set(b)) for a, b in zip(found, base))
    assert right / sum(map(len, base)) > 0.8 and right / sum(map(len, found)) > 0.95
    assert not any(P.added_spans(model, texts, base))


def test_viterbi_equals_enumeration(model):
    import itertools
    rng = np.random.default_rng(1)
    a = model.transitions
    for _ in range(5):
        e = rng.normal(0, 2, (4, len(P.TAGS)))
        paths = [p for p in itertools.product(range(len(P.TAGS)), repeat=4) if not P.TAGS[p[0]].startswith("I-")]
        best = max(paths, key=lambda p: sum(e[i, t] for i, t in enumerate(p)) + sum(a[s, t] for s, t in zip(p, p[1:])))
        assert model.viterbi(e).tolist() == list(best)


def test_windows_do_not_depend_on_the_batch(model):
    texts = _texts(40, 3)
    whole = P.added_spans(model, texts, [[] for _ in texts], at_once=512)
    assert whole == P.added_spans(model, texts, [[] for _ in texts], at_once=3)


def test_table(spark, docs, model):
    rows = [(i, t) for i, t in enumerate(_texts(24, 4))] + [(50, None), (51, ""), (52, "no data"), (None, "a@b.cd"), (0, "é a@b.cd 1.2.3.4"),
                                                           (53, "x" * 60_000 + " a@b.cd")]
    got = P.detect(docs(rows), model, carry="lang string, n_chars long", redacted=True).collect()
    assert len(got) == len(rows)
    by_text = {(i, len(t or "")): t or "" for i, t in rows}
    for r in got:
        text = by_text[r["doc_id"], r["n_chars"]]
        base = brute(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        every = [(k, int(a), int(b)) for k, a, b in spans]
        assert set(base) <= set(every) and len(every) == len(base) + r["n_added"]
        assert every == sorted(every, key=lambda s: (P.KINDS.index(s[0]), s[1]))
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(b[0] == k for b in base) for k in P.KINDS]
        assert (r["redacted"] or "") == P.redact(text, every)
    assert P.detect(docs([]), model).collect() == []
    none = P.detect(docs([(1, "a@b.cd")]), None).collect()
    assert [(r["n_email"], r["n_added"]) for r in none] == [(1, 0)]


def test_fit_without_spans(docs):
    assert P.fit(docs([(1, "nothing"), (2, None)])) is None


def test_fit_learns_every_kind_however_rare(docs):
    rare = _texts(4, 7)                                # one span of each kind
    rare[2] = "plain words " * 4000 + rare[2]          # the only ip stands in a long text
    rows = [(i, f"in {1900 + i % 120} it cost {100 + i} coins, number {i}") for i in range(4000)]
    model = P.fit(docs(rows + [(4000 + i, t) for i, t in enumerate(rare)]))
    texts = _texts(80, 8)
    found = P.added_spans(model, texts, [[] for _ in texts])
    for n, kind in enumerate(("phone", "email", "ip", "card")):
        own = [any(s[0] == kind for s in f) for f in found[n::4]]
        assert sum(own) / len(own) > 0.5, kind


def test_sample_is_bounded_and_even(docs):
    rows = [(i, t) for i, t in enumerate(_texts(80, 9))] + [(100 + i, f"{i}: write to a{i}@b.cd or c{i}@d.ef") for i in range(300)]
    rows += [(500 + i, "the same 10.0.0.1") for i in range(50)]
    got = P.sample(docs(rows), 15, 1 << 15)
    assert [sum(s[0] == k for s in got) for k in P.KINDS] == [15] * 4 and len(set(got)) == 60
    assert sorted(got) == sorted(P.sample(docs(rows[::-1]).repartition(11), 15, 1 << 15))


def test_redact():
    assert P.redact("ab 12 cd", [("card", 3, 5)]) == "ab [CARD] cd"
    assert P.redact("abcdef", [("phone", 1, 4), ("card", 3, 5)]) == "a[PHONE]f"
