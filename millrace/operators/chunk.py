"""Heading-aware chunks within a token budget.

A document's chunks depend on it alone but are a sequential fold (each overlap is cut
from the chunk before, overlap included), so a document is one value of an Arrow-fed
function that returns all its chunks; numbering, ids and the rest are native.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens

#: What opens a section (a comment line in code does, too), and fences.
HEADING = re.compile(r"^(#{1,6})\s+(.*)$", re.MULTILINE)
TAGGED_FENCE = re.compile(r"```(\w*)\n(.*?)```", re.DOTALL)
ANY_FENCE = re.compile(r"```.*?```", re.DOTALL)
PIECE = "array<struct<text:string,base_text:string,heading_path:array<string>>>"


@dataclass(frozen=True)
class ChunkConfig:
    chunk_size_tokens: int = 800
    chunk_overlap_tokens: int = 120
    min_chunk_tokens: int = 40
    max_chunk_tokens: int = 2000
    respect_code_blocks: bool = True
    tokenizer: str | None = None  # None: the default rule

    def __post_init__(self) -> None:
        if self.chunk_overlap_tokens >= self.chunk_size_tokens:
            raise ValueError("chunk_overlap_tokens must be smaller than chunk_size_tokens")


Section = tuple[tuple[str, ...], int, str]  # heading path, level, body


def tokens_of(text: str, config: ChunkConfig) -> int:
    return tokens.count(text, config.tokenizer) if config.tokenizer else len(text.split()) * 13 // 10


def sections_of(text: str) -> Iterator[Section]:
    """The text before the first heading, if any, then each heading's body."""
    marks = list(HEADING.finditer(text))
    if not marks:
        yield (), 0, text
        return
    if before := text[: marks[0].start()].strip():
        yield (), 0, before
    trail: dict[int, str] = {}
    for mark, end in zip(marks, [*(m.start() for m in marks[1:]), len(text)], strict=True):
        level = len(mark[1])
        trail = {k: t for k, t in trail.items() if k < level} | {level: mark[2].strip()}
        yield tuple(trail.values()), level, text[mark.end() : end].strip()


def with_heading(section: Section) -> str:
    path, level, body = section
    if not path:
        return body
    line = f"{'#' * level} {path[-1]}"
    return f"{line}\n\n{body}" if body else line


def paragraphs_of(text: str, keep_fences: bool) -> Iterator[str]:
    """Texts between blank lines; with ``keep_fences`` a fence stays in one piece."""
    at = 0
    for fence in ANY_FENCE.finditer(text) if keep_fences else ():
        yield from (p for p in text[at : fence.start()].split("\n\n") if p.strip())
        yield fence[0]
        at = fence.end()
    yield from (p for p in text[at:].split("\n\n") if p.strip())


def split_oversized(section: Section, config: ChunkConfig) -> Iterator[str]:
    """A section's paragraphs gathered up to the chunk size."""
    body = section[2]
    fences = config.respect_code_blocks and TAGGED_FENCE.search(body) is not None
    held: list[str] = []
    room = config.chunk_size_tokens
    for part in paragraphs_of(body, fences):
        n = tokens_of(part, config)
        if held and n > room:
            yield "\n\n".join(held)
            held, room = [], config.chunk_size_tokens
        held.append(part)
        room -= n
    if held:
        yield "\n\n".join(held)


def packed(text: str, config: ChunkConfig) -> Iterator[tuple[str, tuple[str, ...]]]:
    """Chunks before overlap: (text, heading path of the last section in it)."""
    held: list[str] = []
    path: tuple[str, ...] = ()
    used = 0

    def flushed() -> Iterator[tuple[str, tuple[str, ...]]]:
        whole = "\n\n".join(p for p in held if p.strip())
        if whole.strip() and tokens_of(whole, config) >= config.min_chunk_tokens:
            yield whole, path

    for section in sections_of(text):
        n = tokens_of(section[2], config)
        if n > config.max_chunk_tokens:
            yield from flushed()
            held, used = [], 0
            for part in split_oversized(section, config):
                yield part, section[0]
            continue
        if used and used + n > config.chunk_size_tokens:
            yield from flushed()
            held, used = [], 0
        path = section[0]
        held.append(with_heading(section))
        used += n
    yield from flushed()


def chunks_of(text: str, config: ChunkConfig) -> list[tuple[str, str, list[str]]]:
    """(text with overlap, text without, heading path) of each chunk."""
    take = max(1, int(config.chunk_overlap_tokens / 1.3))
    out: list[tuple[str, str, list[str]]] = []
    for base, path in packed(text, config):
        whole = base
        if out and config.chunk_overlap_tokens > 0 and (tail := " ".join(out[-1][0].split()[-take:])):
            whole = f"{tail}\n\n{base}"
        out.append((whole, base, list(path)))
    return out


def chunk_pieces(text: Column, config: ChunkConfig) -> Column:
    @F.pandas_udf(PIECE)
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield some.map(lambda t: [dict(zip(("text", "base_text", "heading_path"), c, strict=True)) for c in chunks_of(t or "", config)])

    return pieces(text)


def chunk(docs: DataFrame, config: ChunkConfig | None = None, *, id_col: str = "document_id", text: str = "text") -> DataFrame:
    """One row per chunk. Ids and ``contains_code`` are those of the text without overlap."""
    config = config or ChunkConfig()
    rows = docs.select(F.col(id_col), F.posexplode(chunk_pieces(F.col(text), config)).alias("chunk_index", "p"))
    ident = F.concat(F.col(id_col), F.lit("_chunk"), F.col("chunk_index").cast("string"), F.lit("_"), tx.stable_hash("p.base_text", 8))
    return rows.select(
        ident.alias("chunk_id"),
        id_col,
        F.col("p.text").alias("text"),
        (tokens.count_encoded("p.text", config.tokenizer) if config.tokenizer else tx.count_tokens("p.text")).alias("token_count"),
        F.col("p.heading_path").alias("heading_path"),
        "chunk_index",
        F.col("p.base_text").contains("```").alias("contains_code"),
    )


def surviving(chunks: DataFrame, documents: DataFrame, *, id_col: str = "document_id") -> DataFrame:
    """Chunks whose document is there."""
    return chunks.join(documents.select(id_col), id_col, "left_semi")
