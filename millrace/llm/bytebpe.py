"""Byte-level BPE ids of whole texts, equal to those of the ``tokenizers`` library.

The vocabulary is a ``tokenizers`` JSON file whose path is a parameter. Where its merges
are in id order, ``tiktoken`` merges by the same ranks several times faster; it gets all
texts but those on which the two libraries may differ (special tokens, letters beyond
Latin, unusual white space, very long runs), which go to ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the split before merges of byte-level BPE vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ODD = re.compile("[^\\t\\n\\r\\x20-\\x7e¡-ɏ‐-‧€]|\\S{2000}|\\s{2000}")


def default_path() -> str:
    """The public vocabulary of 50,257 ids as installed on this machine."""
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Encoder for one vocabulary file."""

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): k for word, k in vocab.items() if word not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        ordered = all(vocab[a + b] == 256 + k for k, (a, b) in enumerate(pairs))
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ordered else None

    def ids(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.fast is None or _ODD.search(text) or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


@functools.lru_cache(maxsize=2)
def load(path: str | None = None) -> ByteBpe:
    """The encoder for ``path``, loaded once in each worker."""
    return ByteBpe(path or default_path())
