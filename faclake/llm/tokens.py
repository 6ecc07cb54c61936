"""Token ids of whole texts by a byte-level BPE vocabulary.

The vocabulary file is a parameter (``tokenizers`` JSON or the same vocabulary
as ``tiktoken`` ranks); by default it is looked up with the installed
``public_tokenizers``.  The rank form encodes several times faster and gives
the same ids; strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _load(path: str):
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        return lambda text: model.encode(text, add_special_tokens=False).ids, None
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(b) for b in ranks]
    return model.encode_ordinary, sizes


def encode(text: str | None, path: str) -> np.ndarray:
    """Ids of one text (null: none)."""
    return np.array(_load(path)[0](text), np.uint32) if text else np.zeros(0, np.uint32)


def encode_with_ends(text: str | None, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, end byte of each token): tokens of a byte-level vocabulary tile the
    UTF-8 bytes, so the offsets are running sums of their lengths."""
    ids = encode(text, path)
    sizes = _load(path)[1]
    if sizes is None:
        raise ValueError("offsets need the vocabulary in rank form")
    return ids, np.cumsum(sizes[ids])
