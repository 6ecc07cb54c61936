"""Token counts of sections: offset-mapped attribution.

A document is encoded once, whole.  The tokens' character spans are joined with
the spans of its sections by position, and each token counts for one section:
the one that holds most of its characters, the earlier on a tie.  A token that
no section touches counts for section -1.

Sections are the lines of the text (each with its line feed), or a column
``array<struct<start, end>>`` of character spans in order of start; where such
spans overlap, characters belong to the earlier section.  The section number is
the index in that order.  Every section gets a row, also with no token.

Null and empty texts have one empty section (lines) or the sections given, with
no tokens; null spans are empty.  Repeated rows each give their rows; an empty
table gives none.  Texts are taken in slices of about 1 MB, a longer one by itself and
whole.  Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens
from .common import ranges, slices

SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the lines; a text that ends with a line feed has no
    empty line after it."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(code == 10) + 1
    if not len(ends) or ends[-1] < len(code):
        ends = np.append(ends, len(code))
    return np.append(0, ends[:-1]), ends


def attribute(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token span [first, last), number of sections it touches);
    sections are disjoint and sorted."""
    full = np.flatnonzero(end > start)
    s, e = start[full], end[full]
    lo, hi = np.searchsorted(e, first, "right"), np.searchsorted(s, last, "left")
    hi = np.maximum(lo, hi)
    touched = hi - lo
    out = np.where(touched > 0, lo, -1)
    many = np.flatnonzero(touched > 1)
    if len(many):
        which, at = ranges(lo[many], hi[many])
        own = np.minimum(last[many][which], e[at]) - np.maximum(first[many][which], s[at])
        order = np.lexsort((at, -own, which))
        lead = order[np.unique(which[order], return_index=True)[1]]
        out[many] = at[lead]
    return np.where(out >= 0, full[out] if len(full) else -1, -1), touched


def token_counts(docs: DataFrame, sections: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """One row per document and section (SCHEMA); ``n_crossing`` of the tokens
    counted also touch another section."""
    path = vocabulary or tokens.vocabulary()
    columns = ["doc_id", "text"] + ([sections] if sections else [])

    def of(text: str, spans) -> tuple[np.ndarray, ...]:
        ids, ends = tokens.encode_with_ends(text, path)
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80)            # characters begun up to each byte
        begins = np.append(0, ends[:-1])
        first, last = (char[begins] - 1, char[ends - 1]) if len(ids) else (begins[:0], begins[:0])
        if sections is None:
            start, end = line_sections(text)
        else:
            flat = sorted((max(0, x["start"] or 0), max(0, x["end"] or 0)) for x in spans or () if x)
            start, end = (np.array(flat, np.int64).reshape(-1, 2)).T
            seen = np.maximum.accumulate(np.append(0, end[:-1])) if len(end) else end
            start = np.minimum(np.maximum(start, seen), np.maximum(end, start))
            end = np.maximum(start, end)
        own, touched = attribute(first, last, start, end)
        counts = np.bincount(own + 1, minlength=len(start) + 1)
        crossing = np.bincount((own + 1)[touched > 1], minlength=len(start) + 1)
        number, skip = np.arange(-1, len(start)), int(counts[0] == 0)
        return tuple(x[skip:] for x in (number, np.append(0, start), np.append(0, end), counts, crossing,
                                        np.full(len(number), len(ids))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]
        for part in slices(batches, "text"):
            spans = part.column(2).to_pylist() if sections else [None] * part.num_rows
            found = [of(t or "", s) for t, s in zip(part.column(1).to_pylist(), spans)]
            sizes = [len(f[0]) for f in found]
            rows = pa.array(np.repeat(np.arange(len(found)), sizes))
            cols = [pa.array(np.concatenate([f[i] for f in found]), pa.int32() if not i else pa.int64()) for i in range(6)]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()).take(rows), *cols], names=["doc_id", *names])

    return docs.select(*columns).mapInArrow(run, SCHEMA)
