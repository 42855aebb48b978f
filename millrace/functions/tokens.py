"""Token counts by a BPE vocabulary, where one is at hand.

The default count is ``text.count_tokens``, which needs no vocabulary. These functions take
a rank file (base64 token and rank on each line) or an encoding's name; a worker loads it
once, and where it can't be loaded the default rule holds.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Fixed value: the split before merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=8)
def encoding(source: str):
    """The encoding of a rank file or of a name; None if there is none."""
    try:
        import tiktoken

        if "/" not in source:
            return tiktoken.get_encoding(source)
        with open(source, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    except Exception:  # noqa: BLE001 - no library, no file, or no network: the default rule
        return None


def count(text: str, source: str) -> int:
    """Tokens of one text."""
    enc = encoding(source)
    return len(enc.encode_ordinary(text)) if enc else len(text.split()) * 13 // 10


def _cut(text: str, most: int, source: str) -> str:
    if (enc := encoding(source)) is None:
        return " ".join(text.split()[: int(most / 1.3)])
    ids = enc.encode_ordinary(text)
    return text if len(ids) <= most else enc.decode(ids[:most])


def count_encoded(text: Column | str, source: str) -> Column:
    """Tokens of each text; 0 for an empty or null one."""

    @F.pandas_udf("int")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: count(t, source) if t else 0)

    return counted(col(text))


def truncate_encoded(text: Column | str, most: int, source: str) -> Column:
    """The text of the first ``most`` tokens."""

    @F.pandas_udf("string")
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: _cut(t, most, source) if t else t)

    return cut(col(text))
