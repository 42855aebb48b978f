"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built over labelled running text. A text is then
parsed greedily against each automaton: every phrase is the longest match that the
automaton takes from where the last phrase ended, wherever in the text that is; a letter
that the automaton does not know is a phrase of its own. By the phrases' number c the text
has a cross-entropy of c * log2(length of the labelled text) / (length of the text) bits a
letter; the language with the least of it wins.

Running text is the lower-cased letters (Unicode categories L and M) with a single space
in place of whatever stands between, before and after them. Phrases run across words.

What is learned is a bounded sample, ``SAMPLE_DOCS`` whole texts of each language and at
most ``SAMPLE_LETTERS`` letters of them, picked among equal chances by the hash of the
text; texts that do not fit are passed over, and the shortest is taken if none fits. The
sample goes through the driver, so its size is that bound times the number of languages.
Prediction reads whole texts and nothing but them.

Texts are parsed in blocks side by side, a letter of every block at a time. A block is
parsed as if a phrase began at its first letter; the true parse is then led in from the
block before, until it meets a phrase start of the block, from where on both are one. So
counts are those of the parse from the first letter, however long a text is.

Defined results: a null text or one without a letter (category L) is ``und`` with score 0,
as is every text if nothing was learned; languages tie in favour of the first name;
repeated rows each give a row; a null id is passed through, is not held out and is not
learned from; an empty table gives an empty result; other columns are kept by
``with_language`` and not read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize

UNDETERMINED = "und"
SAMPLE_DOCS, SAMPLE_LETTERS = 120, 60_000
BROADCAST_LANGS = 10_000
BLOCK = 512
#: A code beyond all letters, between the texts that are learned.
_BREAK = 0x110000
_SHIFT = 21
_SPACE = 32


@functools.lru_cache(maxsize=1)
def _letter_kinds() -> np.ndarray:
    """For each code point 1 for a letter (L), 2 for a mark (M), else 0."""
    kinds = {"L": 1, "M": 2}
    return np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), dtype=np.uint8, count=0x110000)


def running(text: str | None) -> np.ndarray | None:
    """The codes of a text's running text, None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    kinds = _letter_kinds()[codes]
    if not (kinds == 1).any():
        return None
    codes = np.concatenate([[_SPACE], np.where(kinds > 0, codes, _SPACE), [_SPACE]])
    return codes[np.append(True, (codes[1:] != _SPACE) | (codes[:-1] != _SPACE))]


def suffix_automaton(codes) -> dict[int, int]:
    """Transitions of the automaton of all substrings: state << 21 | code -> state; 0 is the start."""
    step: dict[int, int] = {}
    out: list[list[int]] = [[]]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        out.append([])
        p = last
        while p >= 0 and (p << _SHIFT | code) not in step:
            step[p << _SHIFT | code] = cur
            out[p].append(code)
            p = link[p]
        if p >= 0:
            q = step[p << _SHIFT | code]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                out.append(list(out[q]))
                for d in out[q]:
                    step[copy << _SHIFT | d] = step[q << _SHIFT | d]
                while p >= 0 and step.get(p << _SHIFT | code) == q:
                    step[p << _SHIFT | code] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return step


class Automaton:
    """A suffix automaton in a table of open addresses, which arrays of states follow at once."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, codes: np.ndarray):
        self.length = max(2, len(codes))
        step = self.step = suffix_automaton(codes.tolist())
        keys = np.fromiter(step.keys(), dtype=np.int64, count=len(step))
        ends = np.fromiter(step.values(), dtype=np.int64, count=len(step))
        bits = max(4, int(4 * len(step)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ends = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int64)
        todo, at = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]
            won = self.keys[at[todo]] == keys[todo]
            self.ends[at[todo[won]]] = ends[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self._FACTOR) >> self.shift).view(np.int64)

    def follow(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after the codes, -1 where there is none."""
        keys = (states << _SHIFT) | codes
        at = self._slots(keys)
        found = self.keys[at]
        miss = found != keys
        ends = self.ends[at]
        ends[miss] = -1
        open_ = np.nonzero(miss & (found != -1))[0]
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            ends[open_[hit]] = self.ends[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return ends

    def phrase_end(self, codes: np.ndarray, start: int, end: int) -> int:
        """The end of the phrase that begins at ``start``."""
        state, at = 0, start
        while at < end:
            for code in codes[at : min(end, at + 32)].tolist():
                state = self.step.get(state << _SHIFT | code, -1)
                if state < 0:
                    return max(at, start + 1)
                at += 1
        return at

    def block_starts(self, codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each code whether a phrase begins there, each block parsed by itself."""
        order = np.argsort(-sizes, kind="stable")
        at, sizes = begins[order], sizes[order]
        starts = np.zeros(len(codes), dtype=bool)
        states = np.zeros(len(at), dtype=np.int64)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # blocks with more than t letters
            here, states = at[:n] + t, states[:n]
            code = codes[here]
            after = self.follow(states, code)
            lost = np.nonzero(after < 0)[0]
            fresh_ = states == 0
            fresh_[lost] = True
            starts[here[fresh_]] = True
            if len(lost):
                again = self.follow(np.zeros(len(lost), dtype=np.int64), code[lost])
                after[lost] = np.maximum(again, 0)
            states = after
        return starts

    def phrases(self, codes: np.ndarray, edges: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """Phrases of each text codes[edges[k]:edges[k + 1]]."""
        cuts = [np.arange(a, b, block) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        begins = np.concatenate([*cuts, np.zeros(0, dtype=np.int64)])
        ends = np.concatenate([*(np.append(c[1:], b) for c, b in zip(cuts, edges[1:], strict=True) if len(c)), np.zeros(0, dtype=np.int64)])
        starts = self.block_starts(codes, begins, ends - begins)
        before = np.concatenate([[0], np.cumsum(starts)])
        counts = before[edges[1:]] - before[edges[:-1]]
        for k in np.nonzero(np.diff(edges) > block)[0]:
            counts[k] = self._stitched(codes, starts, before, cuts[k].tolist(), int(edges[k + 1]))
        return counts

    def _stitched(self, codes: np.ndarray, starts: np.ndarray, before: np.ndarray, cuts: list[int], end: int) -> int:
        """Phrases of a text of many blocks."""
        n, at = 0, cuts[0]  # phrases up to ``at``, a phrase start of the true parse
        for a, b in zip(cuts, [*cuts[1:], end], strict=True):
            while at < b and not starts[at]:
                at, n = self.phrase_end(codes, at, end), n + 1
            if at < b:  # here the parses meet; the last phrase may run on into the next block
                last = b - 1 - int(np.argmax(starts[at:b][::-1]))
                n += int(before[b] - before[at])
                at = self.phrase_end(codes, last, end)
        return n


class Parser:
    """Predicts the language of texts from labelled ones."""

    def __init__(self, labelled: tuple[tuple[str, tuple[str, ...]], ...]):
        known = [(lang, [r for r in map(running, texts) if r is not None]) for lang, texts in labelled]
        known = [(lang, some) for lang, some in known if some]
        self.langs = [lang for lang, _ in known]
        self.automata = [Automaton(np.concatenate([x for r in some for x in (r, [_BREAK])])) for _, some in known]

    def entropies(self, texts: list[str | None], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """(rows of texts with letters, bits a letter by language for each of them)."""
        found = [(k, r) for k, r in enumerate(map(running, texts)) if r is not None]
        sizes = np.array([len(r) for _, r in found], dtype=np.int64)
        codes = np.concatenate([*(r for _, r in found), np.zeros(0, dtype=np.int64)])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        bits = [a.phrases(codes, edges, block) * np.log2(a.length) / np.maximum(sizes, 1) for a in self.automata]
        return np.array([k for k, _ in found], dtype=np.int64), np.array(bits).reshape(len(bits), len(found)).T

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(languages, scores): the share of 2 ** -bits that the language has."""
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows, bits = self.entropies(texts)
        if len(rows) and self.langs:
            best = bits.argmin(axis=1)
            weight = np.exp2(bits.min(axis=1)[:, None] - bits)
            scores[rows] = 1 / weight.sum(axis=1)
            for k, b in zip(rows, best, strict=True):
                langs[k] = self.langs[b]
        return langs, scores


@functools.lru_cache(maxsize=2)
def parser(labelled: tuple[tuple[str, tuple[str, ...]], ...]) -> Parser:
    return Parser(labelled)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no rest; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_letters: int = SAMPLE_LETTERS,
) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The texts to learn for each language: a bounded sample of ``docs``."""
    labelled = docs.where(F.col(id_col).isNotNull()).select(F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"))
    labelled = labelled.where("_text is not null and _lang is not null").withColumn("_hash", F.xxhash64("_text"))
    sizes = materialize(labelled.groupBy("_lang").agg(F.count("*").alias("_n")), "language-sizes", narrow=True)
    if sizes.count() <= BROADCAST_LANGS:  # else the hashes are shuffled to their language's row
        sizes = F.broadcast(sizes)
    # Twice as many as are wanted, of equal chances by the text: copies are one.
    chance = F.pmod("_hash", F.lit(1 << 30)) < F.lit(2.0 * sample_docs * (1 << 30)) / F.col("_n")
    drawn = labelled.select("_lang", "_hash", F.length("_text").alias("_size")).join(sizes, "_lang").where(chance).groupBy("_lang", "_hash").agg(F.max("_size").alias("_size"))
    by_lang: dict[str, list[tuple[int, int, int]]] = {}
    for r in drawn.collect():  # about 2 * sample_docs rows of numbers for each language
        by_lang.setdefault(r["_lang"], []).append((r["_hash"] % (1 << 30), r["_hash"], r["_size"]))
    keys = []
    for name, rows in by_lang.items():
        room, taken = sample_letters, 0
        for _, h, size in sorted(rows):
            if size <= room and taken < sample_docs:
                keys.append((name, h))
                room, taken = room - size, taken + 1
        if not taken:
            keys.append((name, min(rows, key=lambda r: (r[2], r[0], r[1]))[1]))
    if not keys:
        return ()
    chosen = F.broadcast(docs.sparkSession.createDataFrame(keys, "_lang string, _hash bigint"))
    rows = labelled.join(chosen, ["_lang", "_hash"]).groupBy("_lang", "_hash").agg(F.min("_text").alias("_text")).collect()
    learned: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        learned.setdefault(r["_lang"], []).append((r["_hash"], r["_text"]))
    return tuple((name, tuple(t for _, t in sorted(some))) for name, some in sorted(learned.items()))


def with_language(docs: DataFrame, labelled, *, text: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, in place of columns of these names."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = parser(labelled)
        for some in texts:
            langs, scores = p.predict(some.tolist())
            yield pd.DataFrame({"lang": langs, "score": scores})

    found = fresh(docs, "predicted")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (lang_col, score_col)]
    return docs.withColumn(found, predicted(F.col(text).cast("string"))).select(
        *others, F.col(f"{found}.lang").alias(lang_col), F.col(f"{found}.score").alias(score_col)
    )


def identify(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred``, ``score``: learned on what is not held out."""
    labelled = learn(docs.where(~held_out(F.col(id_col), folds)), id_col=id_col, text=text, lang=lang)
    rows = docs.select(F.col(id_col), F.col(text).alias("_text"), held_out(F.col(id_col), folds).alias("held_out"))
    return with_language(rows, labelled, text="_text").select(id_col, "held_out", "lang_pred", "score")
