"""Personal data: fixed patterns and a character-level BiLSTM-CRF.

The base spans of email, ip, card and phone follow fixed patterns (leftmost,
not overlapping, per kind).  A character tagger, a bidirectional LSTM whose
emissions enter a linear-chain CRF, is trained in numpy on labelled spans: a
bounded sample of each kind's base spans, however rare the kind is, also in
spellings that the patterns miss.  It adds spans of the same kinds; base spans
always stay.

Whole texts are tagged.  Overlapping windows cover a text; the emissions of a
character are averaged over its windows, weighted towards their middles, and one
Viterbi pass over each connected stretch of windows settles the tags.  Every
span of these kinds holds a digit or an @, so windows with neither are O without
running the network.  An added span must pass the check of its kind, lead O by
``margin`` on average, and touch no base span.

Null and empty texts have no spans.  Without any labelled span there is no
tagger and the base spans stand alone.  Repeated rows give equal rows; an empty
table gives none; extra columns are ignored.  Offsets count code points, ends
exclusive.  n_email to n_phone count base spans, n_added the tagger's.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, only, slices, text_buffer

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits fails or matches as the run's start does, so
# only starts of runs are tried: long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*range(0x30, 0x3A), 0x40]] = True


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 16 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in the order of KINDS, then by start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:                                     # emails: around each @, in order
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
            done = host.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))
    for kind, pattern, good in (("ip", _IP, _is_ip), ("card", _CARD, _is_card),
                                ("phone", _PHONE, lambda t: 8 <= len(_digits(t)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m[0])]
    return out


# ------------------------------------------------------------------ the tagger

TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
_FORBIDDEN = np.array([[t.startswith("I-") and s[2:] != t[2:] for t in TAGS] for s in TAGS])
_N_CHARS = 100


def char_codes(text: str) -> np.ndarray:
    """Printable ASCII by itself; blanks, other letters and other characters as classes."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.full(len(code), 97)
    ascii_ = (code >= 32) & (code < 127)
    out[ascii_] = code[ascii_] - 32
    out[code < 32] = 95
    out[(code >= 0xC0) & (code < 0x2000)] = 96
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, w: np.ndarray, keep: list | None = None) -> np.ndarray:
    """x: steps, batch, inputs; w: (inputs + hidden + 1, 4 hidden)."""
    steps, batch, n_in = x.shape
    n = w.shape[1] // 4
    h, c, out = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype), np.empty((steps, batch, n), x.dtype)
    outer, inner = w[:n_in], w[n_in:-1]
    for t in range(steps):
        z = x[t] @ outer + w[-1] + h @ inner           # step by step: for all at once it is the largest array here
        gates = _sigmoid(z[:, :3 * n])
        i, f, o, g = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:], np.tanh(z[:, 3 * n:])
        before, c = (h, c), f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep is not None:
            keep.append((*before, i, f, o, g, tc))
    return out


def _lstm_back(x, w, kept, d_out) -> tuple[np.ndarray, np.ndarray]:
    steps, batch, n_in = x.shape
    n = w.shape[1] // 4
    inner = w[n_in:-1]
    d_z = np.empty((steps, batch, 4 * n), x.dtype)
    dh, dc = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype)
    for t in range(steps - 1, -1, -1):
        _, c0, i, f, o, g, tc = kept[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        d_z[t] = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dh, dc = d_z[t] @ inner.T, dc * f
    flat = d_z.reshape(-1, 4 * n)
    h0 = np.stack([k[0] for k in kept]).reshape(-1, n)
    d_w = np.concatenate([x.reshape(-1, n_in).T @ flat, h0.T @ flat, flat.sum(axis=0, keepdims=True)])
    return (flat @ w[:n_in].T).reshape(x.shape), d_w


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    p: dict = field(default_factory=dict)              # embedding, forward, backward, output, transitions

    @classmethod
    def new(cls, rng, embed: int = 12, hidden: int = 16) -> "Tagger":
        r = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        code = np.arange(_N_CHARS)                     # digits begin alike, and so do letters
        alike = np.where((code >= 16) & (code < 26), 16, np.where((code >= 33) & (code < 59), 33, np.where((code >= 65) & (code < 91), 65, code)))
        p = {"e": rng.normal(0, 1, (_N_CHARS, embed))[alike] + rng.normal(0, 0.05, (_N_CHARS, embed)), "f": r(embed + hidden + 1, 4 * hidden), "b": r(embed + hidden + 1, 4 * hidden),
             "o": r(2 * hidden + 1, len(TAGS)), "t": np.zeros((len(TAGS), len(TAGS)))}
        for d in "fb":
            p[d][-1] = 0
            p[d][-1, hidden:2 * hidden] = 1            # forget gates start open
        return cls(p)

    @property
    def transitions(self) -> np.ndarray:
        return np.where(_FORBIDDEN, -1e4, self.p["t"])

    def emissions(self, codes: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """codes: batch, steps -> batch, steps, tags."""
        x = self.p["e"][codes.T]
        kf, kb = ([], []) if kept is not None else (None, None)
        h = np.concatenate([_lstm(x, self.p["f"], kf), _lstm(x[::-1], self.p["b"], kb)[::-1]], axis=2)
        if kept is not None:
            kept.update(x=x, f=kf, b=kb, h=h)
        return (h @ self.p["o"][:-1] + self.p["o"][-1]).swapaxes(0, 1)

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Negative log-likelihood per window of the CRF, and its gradient."""
        kept: dict = {}
        e, a = self.emissions(codes, kept).swapaxes(0, 1), self.transitions
        y, (steps, batch, n) = tags.T, e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + a, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _lse(alpha[-1], 1)
        d_e = np.exp(alpha + beta - total[:, None])
        pair = np.exp(alpha[:-1, :, :, None] + a + (e[1:] + beta[1:])[:, :, None, :] - total[:, None, None]).sum(axis=(0, 1))
        grid = np.arange(steps)[:, None], np.arange(batch)
        gold = e[grid[0], grid[1], y].sum(axis=0) + a[y[:-1], y[1:]].sum(axis=0)
        d_e[grid[0], grid[1], y] -= 1
        np.subtract.at(pair, (y[:-1].ravel(), y[1:].ravel()), 1)
        d_e, x, h = d_e / batch, kept["x"], kept["h"]
        flat = d_e.reshape(-1, n)
        hidden = h.shape[2] // 2
        g = {"o": np.concatenate([h.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0, keepdims=True)]), "t": np.where(_FORBIDDEN, 0, pair / batch)}
        d_h = d_e @ self.p["o"][:-1].T
        dxf, g["f"] = _lstm_back(x, self.p["f"], kept["f"], d_h[:, :, :hidden])
        dxb, g["b"] = _lstm_back(x[::-1], self.p["b"], kept["b"], d_h[::-1, :, hidden:])
        g["e"] = np.zeros_like(self.p["e"])
        np.add.at(g["e"], codes.T, dxf + dxb[::-1])
        return float((total - gold).mean()), g

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags of one stretch: steps, tags."""
        a, back = self.transitions, np.empty(e.shape, np.int64)
        score = e[0] + np.where([t.startswith("I-") for t in TAGS], -1e4, 0)
        for t in range(1, len(e)):
            both = score[:, None] + a
            back[t] = both.argmax(axis=0)
            score = e[t] + both.max(axis=0)
        out = np.empty(len(e), np.int64)
        out[-1] = score.argmax()
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


def _respell(kind: str, text: str, rng) -> str:
    """Another value of a labelled span, and sometimes another spelling."""
    out = "".join(str(rng.integers(10)) if c.isdigit() else "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)]
                  if kind == "email" and c.isalpha() and i < text.find("@") else c for i, c in enumerate(text))
    if kind == "ip":
        out = ".".join(str(rng.integers(256)) for _ in range(4))
    style = rng.integers(4)
    if kind == "phone" and style:
        d = _digits(out)[-10:]
        if len(d) == 10:
            out = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[style - 1]
    if kind == "card":
        d = _digits(out)
        d = next(d[:-1] + c for c in "0123456789" if luhn(d[:-1] + c))
        sep = ("", " ", "-", ".")[style]
        out = sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == "email" and style == 3:
        out = out.replace("@", " @ ")
    return out


def _distractor(rng) -> str:
    d = lambda n: "".join(str(rng.integers(10)) for _ in range(n))
    return (d(rng.integers(1, 13)), f"20{d(2)}-0{rng.integers(1, 10)}-{d(2)}", f"{d(1)}.{d(2)}.{d(1)}", f"{d(2)}:{d(2)}", f"{d(3)},{d(3)}",
            f"{d(4)}-{d(4)}", f"@{d(3)}", f"${d(2)}.{d(2)}")[rng.integers(8)]


_WINDOW = 48


def labelled(text: str, window: int = _WINDOW) -> list[tuple[str, str, str, str]]:
    """(kind, text before, value, text after) of each base span."""
    return [(k, text[max(0, a - window):a], text[a:b], text[b:b + window]) for k, a, b in base_spans(text)]


def train(texts: Sequence[str], window: int = _WINDOW, **more) -> Tagger | None:
    """``train_on`` the base spans of ``texts``."""
    return train_on([s for t in texts for s in labelled(t, window)], window, **more)


def train_on(spans: Sequence[tuple[str, str, str, str]], window: int = _WINDOW, examples: int = 1200, steps: int = 160, batch: int = 48,
             seed: int = 11, rate: float = 0.05) -> Tagger | None:
    """Adam on windows around labelled spans (None without any); half of them
    respelt, a third with numbers that are no personal data."""
    rng = np.random.default_rng(seed)
    if not spans:
        return None
    by_kind = {k: [x for x in spans if x[0] == k] for k in KINDS}
    kinds = [k for k in KINDS if by_kind[k]]
    codes, tags = np.empty((examples, window), np.int64), np.zeros((examples, window), np.int64)
    for n in range(examples):
        own = by_kind[kinds[n % len(kinds)]]
        kind, left, value, right = own[rng.integers(len(own))]
        value = value if rng.random() < 0.4 else _respell(kind, value, rng)
        if rng.random() < 0.34:                        # a number in place of the span
            value, kind = _distractor(rng), None
        whole, at = left + value + right, len(left)
        marks = np.zeros(len(whole), np.int64)
        for k, s, e in base_spans(left) + [(k, s + at + len(value), e + at + len(value)) for k, s, e in base_spans(right)]:
            marks[s], marks[s + 1:e] = TAGS.index(f"B-{k}"), TAGS.index(f"I-{k}")
        if kind:
            marks[at], marks[at + 1:at + len(value)] = TAGS.index(f"B-{kind}"), TAGS.index(f"I-{kind}")
        first = int(np.clip(at - rng.integers(0, max(1, window - min(len(value), window))), 0, max(0, len(whole) - window)))
        piece = whole[first:first + window].ljust(window)
        codes[n] = char_codes(piece)
        tags[n, :len(marks[first:first + window])] = marks[first:first + window]
    model = Tagger.new(rng)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        rows = rng.integers(0, examples, batch)
        _, g = model.gradient(codes[rows], tags[rows])
        norm = np.sqrt(sum((v * v).sum() for v in g.values()))
        lr = rate * (1 - 0.9 * step / steps)
        for k, v in g.items():
            v = v * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            model.p[k] -= lr * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Tagger({k: v.astype(np.float32) for k, v in model.p.items()})


def _good(kind: str, text: str) -> bool:
    d = _digits(text)
    if kind == "email":
        return re.fullmatch(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text) is not None
    if kind == "ip":
        return text.count(".") == 3 and all(p.isascii() and p.isdigit() for p in text.split(".")) and _is_ip(text)
    if kind == "card":
        return re.fullmatch(r"[0-9]([ .-]?[0-9])+", text) is not None and _is_card(text)
    return re.fullmatch(r"[+(]?[0-9][ ().0-9-]+[0-9]", text) is not None and 8 <= len(d) <= 15 and len(d) < len(text)


def added_spans(model: Tagger, texts: Sequence[str], base: Sequence[list], window: int = 96, stride: int = 48,
                margin: float = 0.5, at_once: int = 512) -> list[list[tuple[str, int, int]]]:
    """Spans of the tagger that touch no base span, for each text."""
    codes = [char_codes(t) for t in texts]
    jobs = []                                          # (text, window start)
    for i, t in enumerate(texts):
        code = codes[i]
        at = np.flatnonzero(((code >= 16) & (code < 26)) | (code == 32))
        near = set()
        for k in np.unique(at // stride).tolist():     # every window that holds a trigger
            near.update(range(max(0, k - (window - 1) // stride), k + 1))
        jobs += [(i, k * stride) for k in sorted(near) if k * stride < len(code)]
    weight = np.minimum(np.arange(1, window + 1), np.arange(window, 0, -1)).astype(np.float32)
    out: list[list] = [[] for _ in texts]
    state: dict[int, tuple] = {}
    last_of = {i: n for n, (i, _) in enumerate(jobs)}
    for a in range(0, len(jobs), at_once):
        batch = np.full((len(jobs[a:a + at_once]), window), 95)
        for r, (i, s) in enumerate(jobs[a:a + at_once]):
            piece = codes[i][s:s + window]
            batch[r, :len(piece)] = piece
        scores = model.emissions(batch)
        for r, (i, s) in enumerate(jobs[a:a + at_once]):
            if i not in state:
                state[i] = np.zeros((len(codes[i]), len(TAGS)), np.float32), np.zeros(len(codes[i]), np.float32)
            total, mass = state[i]
            n = min(window, len(codes[i]) - s)
            total[s:s + n] += scores[r, :n] * weight[:n, None]
            mass[s:s + n] += weight[:n]
            if last_of[i] == a + r:                    # all windows of the text are in: settle it
                out[i] = _settle(model, texts[i], *state.pop(i), base[i], margin)
    return out


def _settle(model, text, total, mass, base, margin) -> list[tuple[str, int, int]]:
    found = []
    seen = np.flatnonzero(mass > 0)
    for part in np.split(seen, np.flatnonzero(np.diff(seen) > 1) + 1):
        e = total[part] / mass[part][:, None]
        tags = model.viterbi(e)
        start = 0
        while start < len(tags):
            if tags[start] == 0:
                start += 1
                continue
            end = start + 1
            while end < len(tags) and tags[end] and TAGS[tags[end]][0] == "I":
                end += 1
            kind, a, b = TAGS[tags[start]][2:], int(part[0]) + start, int(part[0]) + end
            lead = float((e[np.arange(start, end), tags[start:end]] - e[start:end, 0]).mean())
            if lead >= margin and _good(kind, text[a:b]) and all(b <= s or a >= t for _, s, t in base):
                found.append((kind, a, b))
            start = end
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


# --------------------------------------------------------------------- on Spark

_SAMPLE = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("before", pa.string()), ("value", pa.string()), ("after", pa.string())])
_SAMPLE_DDL = "kind string, key long, before string, value string, after string"


def sample(docs: DataFrame, per_kind: int, most: int) -> list[tuple[str, str, str, str]]:
    """Of each kind, the ``per_kind`` labelled spans with the smallest hashes, one
    of each document and equal ones once; at most the first ``most`` characters of a value."""

    def best(found: dict) -> dict:
        return dict(sorted(found.items())[:per_kind])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict] = {k: {} for k in KINDS}
        for batch in slices(batches, "text", 1 << 19):
            data, off = text_buffer(batch.column(0))
            hits = np.concatenate([[0], np.cumsum(_TRIGGER[data])])
            for i in np.flatnonzero(hits[off[1:]] > hits[off[:-1]]).tolist():
                own: dict[str, tuple] = {}
                for kind, before, value, after in labelled(batch.column(0)[i].as_py()):
                    piece = (kind, before, value[:most], after)
                    key = int.from_bytes(hashlib.blake2b("\0".join(piece).encode(), digest_size=8).digest(), "big") >> 1
                    own[kind] = min(own.get(kind, (key, piece)), (key, piece))
                for kind, (key, piece) in own.items():
                    found[kind][key] = piece
                    if len(found[kind]) >= 2 * per_kind:
                        found[kind] = best(found[kind])
        rows = [(p[0], key, *p[1:]) for own in found.values() for key, p in best(own).items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SAMPLE)], schema=_SAMPLE)

    def again(table: pa.Table) -> pa.Table:
        rows = best({r["key"]: r for r in table.to_pylist()})
        return pa.Table.from_pylist(list(rows.values()), schema=_SAMPLE)

    # the tasks' spans meet in parts of the hashes first, so no task reads those of all
    left = only(in_small_batches(docs), text="string").mapInArrow(first, _SAMPLE_DDL)
    left = left.groupBy("kind", F.expr("pmod(key, 64)")).applyInArrow(again, _SAMPLE_DDL)
    rows = left.groupBy("kind").applyInArrow(again, _SAMPLE_DDL).collect()
    return [(r["kind"], r["before"], r["value"], r["after"]) for r in sorted(rows, key=lambda r: (KINDS.index(r["kind"]), r["key"]))]


def fit(docs: DataFrame, sample_rows: int = 400, sample_bytes: int = 1 << 15) -> Tagger | None:
    """Train on labelled spans of at most ``sample_rows`` documents, an equal number
    for each kind, picked among all documents that hold a span of the kind."""
    return train_on(sample(docs, max(1, sample_rows // len(KINDS)), sample_bytes))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or group of overlapping spans, replaced by its first kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


_JOINED = "base_sha256 string, spans string"
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, " + _JOINED + ", n_added long"


def detect(docs: DataFrame, model: Tagger | None, carry: str = "", redacted: bool = False) -> DataFrame:
    """One row per document (SCHEMA); ``redacted``: also the text with the spans
    replaced; ``carry`` as in decontamination."""
    extra = [c.strip().split(" ")[0] for c in carry.split(",") if c.strip()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        for batch in slices(batches, "text", 1 << 19):
            data, off = text_buffer(batch.column(1))
            hits = np.concatenate([[0], np.cumsum(_TRIGGER[data])])
            rows = np.flatnonzero(hits[off[1:]] > hits[off[:-1]])
            texts = [batch.column(1)[int(i)].as_py() for i in rows]
            base = [base_spans(t) for t in texts]
            more = added_spans(shared.value, texts, base) if shared.value is not None and texts else [[] for _ in texts]
            n = batch.num_rows
            counts = np.zeros((n, 4), np.int64)
            digest, spans, added = [hashlib.sha256(b"").hexdigest()] * n, [""] * n, np.zeros(n, np.int64)
            changed = {}
            for i, text, own, new in zip(rows.tolist(), texts, base, more):
                for k, _, _ in own:
                    counts[i, KINDS.index(k)] += 1
                every = sorted(own + new, key=lambda s: (KINDS.index(s[0]), s[1]))
                digest[i], spans[i], added[i] = hashlib.sha256(join(own).encode()).hexdigest(), join(every), len(new)
                if redacted and every:
                    changed[i] = redact(text, every)
            columns = [batch.column(0).cast(pa.int64()), *[pa.array(counts[:, k]) for k in range(4)], pa.array(digest), pa.array(spans), pa.array(added)]
            names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
            if redacted:
                columns.append(pa.array([changed.get(i, t) for i, t in enumerate(batch.column(1).to_pylist())], pa.string()))
                names.append("redacted")
            columns += [batch.column(batch.schema.get_field_index(c)) for c in extra]
            yield pa.RecordBatch.from_arrays(columns, names=names + extra)

    schema = SCHEMA + (", redacted string" if redacted else "") + (f", {carry}" if carry else "")
    return in_small_batches(docs).select("doc_id", "text", *[c for c in extra if c != "text"]).mapInArrow(run, schema)
