"""SentencePiece encoding by a streaming Viterbi search, and decoding.

A text becomes the piece sequence of highest total score. The search reads the text once
and extends one boundary after the other. It holds best scores for the boundaries that a
piece may still reach, at most as many as the longest piece has letters, and back-pointers
from the last committed boundary on. Back-pointers are a tree; a boundary that no path
uses any more is taken out at once, and as soon as all surviving paths run through one
boundary, the ids before it are committed and let go. Whole texts are read, of any
length, with memory for what is not yet committed.

What the search commits from one boundary to another depends on nothing before, and if no
piece walk looked further than the letter after, on nothing behind either. So the search
remembers its own results: a stretch up to the next word's mark whose both ends it
committed is looked up, in a table of bounded size, when it comes again. There is no
other way to an id than this search.

Letters without a piece become byte pieces (or the unknown id).

Defined results: a null or empty text has no ids and decodes to the empty text; repeated
rows each give a row; null ids are passed through; an empty table gives an empty result;
other columns are not read. A text's own U+2581 marks are white space, as the format has
it; all else decodes to the text itself if the vocabulary has byte pieces.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Entries of the table of results, and the longest stretch that it holds.
MEMO_WORDS, MEMO_LETTERS = 600_000, 64
#: Stretches of a marked text: white space and the word after it.
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NONE = float("-inf")
_NO_PIECE = (None, {})


class Vocabulary:
    """Pieces and scores of a model file."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], unknown: int, names: list[str]):
        self.pieces, self.byte_ids, self.unknown = pieces, byte_ids, unknown
        self.longest = max(map(len, pieces), default=1)
        #: By letter: (id and score of the piece that ends here or None, the like for the next letter).
        self.trie: dict = {}
        for p, hit in sorted(pieces.items()):
            below = self.trie
            for letter in p[:-1]:
                below = below.setdefault(letter, (None, {}))[1]
            below[p[-1]] = (hit, {})
        self.floor = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        id_byte = {i: b for b, i in byte_ids.items()}
        self.bytes_of = [bytes([id_byte[i]]) if i in id_byte else n.replace(MARK, " ").encode() for i, n in enumerate(names)]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        sp = SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(len(sp))]
        plain = [i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        byte_ids = {int(names[i][3:5], 16): i for i in range(len(sp)) if sp.is_byte(i)}
        names = ["" if sp.is_control(i) else n for i, n in enumerate(names)]
        return cls({names[i]: (i, sp.get_score(i)) for i in plain}, byte_ids, sp.unk_id(), names)


class StreamingViterbi:
    """Feed letters, get committed ids; ``close`` ends the text.

    ``text`` holds letters from a little before the committed boundary ``root`` on, and
    boundaries are numbered within it. Scores stand at no more than ``longest`` + 1
    boundaries at once: from ``at``, the next to extend, to ``reach``, the furthest end.
    """

    def __init__(self, vocab: Vocabulary, letters: str = ""):
        self.vocab = vocab
        self.text = letters
        self.root = self.at = self.reach = 0
        self.seen = 0  # one past the last letter that a piece walk looked at, or would have
        grown = len(letters)
        self.best = [0.0] + [_NONE] * grown
        self.back = [-1] * (grown + 1)  # start of the piece that ends at a boundary; -1: none that survives
        self.piece = [-1] * (grown + 1)  # and its id, -1 for a letter without a piece
        self.uses = [0] * (grown + 1)  # boundaries whose surviving path comes directly from this one
        self.widest = self.scores = 0  # most letters after a committed boundary, most scores at once

    def feed(self, letters: str) -> list[int]:
        self.add(letters)
        ids = self.advance(len(self.text) - self.vocab.longest + 1)
        if self.root > 4096:  # let go of what is committed
            gone = self.root
            self.text = self.text[gone:]
            for held in (self.best, self.piece, self.uses):
                del held[:gone]
            self.back = [b - gone if b >= gone else -1 for b in self.back[gone:]]
            self.root, self.at, self.reach, self.seen = 0, self.at - gone, self.reach - gone, self.seen - gone
        return ids

    def add(self, letters: str) -> None:
        """More letters, not yet searched."""
        self.text += letters
        grown = len(letters)
        self.best += [_NONE] * grown
        self.back += [-1] * grown
        self.piece += [-1] * grown
        self.uses += [0] * grown

    def close(self) -> list[int]:
        """The ids of the rest; the text ends here, where all paths meet."""
        return self.advance(len(self.text))

    def advance(self, stop: int, commit: int | None = None) -> list[int]:
        """Extend the boundaries before ``stop``, or until ``commit`` or one after it is committed; the ids committed."""
        text, trie, floor, n = self.text, self.vocab.trie, self.vocab.floor, len(self.text)
        best, back, piece, uses = self.best, self.back, self.piece, self.uses
        s, root, reach, seen = self.at, self.root, self.reach, self.seen
        out: list[int] = []
        while s < stop and (commit is None or root < commit):
            base, e, below = best[s], s, trie
            while below:
                if e == n:
                    e += 1  # more letters would have been looked at
                    break
                hit, below = below.get(text[e], _NO_PIECE)
                e += 1
                if hit is None:
                    if e != s + 1:
                        continue
                    hit = (-1, floor)  # a letter without a piece of its own
                score = base + hit[1]
                if score > best[e]:
                    if back[e] >= 0:
                        self._unused(back[e], root)
                    best[e], back[e], piece[e] = score, s, hit[0]
                    uses[s] += 1
                    if e > reach:
                        reach = e
            if e > seen:
                seen = e
            if not uses[s] and s > root:
                before, back[s] = back[s], -1
                self._unused(before, root)
            if reach - s > self.scores:
                self.scores = reach - s
            s += 1
            if s - root > self.widest:
                self.widest = s - root
            # Do all surviving paths run through one boundary?
            if reach == s:
                done = s  # one boundary is left
            elif uses[root] == 1:
                done = root
                for e in range(root + 1, s):  # along the one path, as far as it does not part
                    if back[e] == done:
                        done = e
                        if uses[e] != 1:
                            break
            else:
                continue
            if done > root:
                out += self._ids(root, done)
                root = done
        self.at, self.root, self.reach, self.seen = s, root, reach, seen
        return out

    def _unused(self, e: int, root: int) -> None:
        """A path from boundary e is gone; take out the boundaries that no path uses then."""
        back, uses = self.back, self.uses
        uses[e] -= 1
        while e > root and not uses[e]:
            before = back[e]
            back[e] = -1
            uses[before] -= 1
            e = before

    def _ids(self, root: int, to: int) -> list[int]:
        """Ids of the path between two boundaries."""
        v, ids, e = self.vocab, [], to
        while e > root:
            s = self.back[e]
            if self.piece[e] >= 0:
                ids.append(self.piece[e])
            elif v.byte_ids:
                ids.extend(v.byte_ids[b] for b in reversed(self.text[s:e].encode("utf-8", "surrogatepass")))
            else:
                ids.append(v.unknown)
            e = s
        return ids[::-1]


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder(dict):
    """Ids of texts; as a dict, the search's own results by stretch, as bytes.

    When the table is full it becomes the older one, and stretches that are met again come
    back from there: common words stay, in two tables of half the bound each.
    """

    def __init__(self, vocab: Vocabulary, memo_words: int = MEMO_WORDS):
        super().__init__()
        self.vocab, self.half, self.older = vocab, memo_words // 2, {}

    def search(self, marked: str, step: int = 4096) -> list[int]:
        """Ids of a marked text by the streaming search, fed in steps, without the table."""
        stream, ids = StreamingViterbi(self.vocab), []
        for at in range(0, len(marked), step):
            ids += stream.feed(marked[at : at + step])
        return ids + stream.close()

    def _remember(self, stretch: str, ids: bytes) -> None:
        if len(stretch) <= MEMO_LETTERS:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        stretches = _STRETCH.findall(marked)
        parts = list(map(self.get, stretches))
        k = at = 0  # stretch k begins at the committed boundary ``at``
        for new in [i for i, ids in enumerate(parts) if ids is None]:
            if new < k:
                continue  # taken by the search before
            at += sum(map(len, stretches[k:new]))
            k, n, stretch = new, 1, stretches[new]
            ids = self.get(stretch)  # since found in this text
            if ids is None and (ids := self.older.get(stretch)) is not None:
                self._remember(stretch, ids)
            if ids is None:
                ids, n = self._searched(marked, at, stretches, k)
            parts[k : k + n] = [ids, *[b""] * (n - 1)]
            at += sum(map(len, stretches[k : k + n]))
            k += n
        return b"".join(parts)

    def _searched(self, marked: str, at: int, stretches: list[str], k: int) -> tuple[bytes, int]:
        """The search from the committed boundary ``at``, where stretch k begins, till it commits the end of one.

        Returns the ids and the number of stretches that they take.
        """
        size, ahead = len(stretches[k]), self.vocab.longest
        stream, ids, end = StreamingViterbi(self.vocab, marked[at : at + size + ahead]), [], 0
        for j in range(k, len(stretches)):
            end += len(stretches[j])
            while stream.root < end:
                held = at + len(stream.text)
                if held < len(marked) and len(stream.text) - stream.at <= ahead:
                    stream.add(marked[held : held + size + 2 * ahead])
                    held = at + len(stream.text)
                ids += stream.advance(len(stream.text) - (ahead if held < len(marked) else 0), end)
            if stream.root == end:
                found = _packed(ids)
                # No walk looked beyond the letter after the end: so it is wherever the stretch stands.
                if j == k and at + end < len(marked) and stream.seen <= end + 1:
                    self._remember(stretches[k], found)
                return found, j + 1 - k
        raise AssertionError("all paths meet at the end of a text")

    def decode(self, ids: bytes) -> str:
        pieces = self.vocab.bytes_of
        text = b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def load(path: str | None = None) -> Encoder:
    """The encoder for a model file, loaded once in each worker."""
    return Encoder(Vocabulary.load(path or default_path()))


def _mapped(df: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, model: str | None, apply) -> DataFrame:
    """``df`` with ``source`` replaced by ``target``, the encoder's ``apply`` of it."""
    names = [c for c in df.columns if c != source]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField(target, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                values = pa.array([apply(encoder, x.as_py()) for x in batch.column(source)], arrow)
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], values], names=[*names, target])

    return df.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, *, keep: list[str], text: str = "text", model: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``ids``, the binary of each text's ids."""
    kept = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_body"))
    return _mapped(kept, "_body", "ids", T.BinaryType(), pa.binary(), model, Encoder.encode)


def decode_documents(encoded: DataFrame, *, ids: str = "ids", target: str = "text", model: str | None = None) -> DataFrame:
    """The other columns and the text of each row's ids."""
    return _mapped(encoded, ids, target, T.StringType(), pa.string(), model, lambda e, b: e.decode(b or b""))


def round_trips(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """``id_col``, ``n_ids``, ``ids_crc32``, ``decoded_sha256`` and ``exact``, per document.

    Texts are encoded and decoded in one pass; ids and texts, several times the size of
    what is told of them, stay in the worker.
    """
    kept = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("_body"))
    told = {"n_ids": T.LongType(), "ids_crc32": T.LongType(), "decoded_sha256": T.StringType(), "exact": T.BooleanType()}
    schema = T.StructType([kept.schema[id_col], *[T.StructField(n, t) for n, t in told.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(model)
        for batch in batches:
            n_ids, crc, sha, exact = [], [], [], []
            for body in batch.column("_body"):
                body = body.as_py()
                ids = encoder.encode(body)
                back = encoder.decode(ids)
                n_ids.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                sha.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                exact.append(back == body.replace(MARK, " "))
            arrays = [batch.column(id_col), pa.array(n_ids, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(exact, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return kept.mapInArrow(run, schema)
