"""Sum-of-squares online packing of token sequences.

Documents arrive one by one. A document of at least ``capacity`` ids first fills whole
sequences; what is left of it goes to the open window whose choice leaves the least sum of
squared counts N(h) of windows at fill level h, tracked in a level array; a new window is
one of the choices. At most ``most_open`` windows stand open. When so many do, no new one
may be opened, and a document that fits none of them is cut: the same rule picks the window
that its first part fills, where what is over counts as a window of its own, and what is
over is placed by the rule again. So every piece goes to a window by the level array, and
at a task's end no more than ``most_open`` windows are left, whatever it has packed.

Those last windows are emptied into each other: pieces are cut so as to fill whole
sequences, and the last remainder goes to sequences of power-of-two lengths, which need no
padding. Each task packs its own input, so there is no shuffle and no shared state; a task
that is lost and run again on the same input makes the same sequences.

Defined results: a null text counts as empty and gives the end id alone; null and
repeated ids are passed through, each row with pieces of its own; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytebpe
from .common import release

CAPACITY = 1024
#: Windows that a task holds open at most: its memory, and the work at its end.
MOST_OPEN = 32
_BIG = 1 << 40
_OUT_ROWS = 8192

Piece = tuple[object, int, np.ndarray, int]  # id, start, ids, ids of the document


class SumOfSquares:
    """Open windows by fill level; closed ones are handed to ``emit``."""

    def __init__(self, capacity: int, emit, most_open: int = MOST_OPEN):
        self.capacity, self.emit, self.most_open = capacity, emit, max(1, most_open)
        self.open: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        # What the sum of squares changes by when a window leaves or reaches a level.
        self.leave = np.full(capacity + 1, _BIG, dtype=np.int64)
        self.arrive = np.ones(capacity + 1, dtype=np.int64)
        self.leave[0] = self.arrive[capacity] = 0
        self.n_open = 0
        self.placed = self.drained = 0  # ids that the rule placed, ids left at the end

    def _set(self, level: int, by: int) -> None:
        n = self.count[level] = self.count[level] + by
        self.leave[level] = 1 - 2 * n if n else _BIG
        self.arrive[level] = 2 * n + 1

    def level_for(self, size: int) -> int:
        """The fill level (0: a new window) that takes ``size``, whole if any can; the fullest of ties."""
        last, full = self.capacity - size, self.n_open >= self.most_open
        cost = self.leave[: last + 1] + self.arrive[size:]
        if full:
            cost[0] = _BIG
        best = int(last - np.argmin(cost[::-1]))
        if cost[best] < _BIG // 2:
            return best
        # Full, and all open windows lack room: what is over counts as a new window.
        over = self.leave[last + 1 : self.capacity] + self.arrive[1:size]
        return int(self.capacity - 1 - np.argmin(over[::-1]))

    def place(self, piece: Piece) -> None:
        doc_id, start, ids, n = piece
        while len(ids):
            level = self.level_for(len(ids))
            pieces = []
            if level:
                pieces = self.open[level].pop()
                self._set(level, -1)
                self.n_open -= 1
            part = ids[: self.capacity - level]
            pieces.append((doc_id, start, part, n))
            start, ids, level = start + len(part), ids[len(part) :], level + len(part)
            self.placed += len(part)
            if level == self.capacity:
                self.emit(pieces)
            else:
                self.open[level].append(pieces)
                self._set(level, 1)
                self.n_open += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        """Place a document's ids, cutting whole sequences off first."""
        n, c = len(ids), self.capacity
        whole = n - n % c
        for at in range(0, whole, c):
            self.emit([(doc_id, at, ids[at : at + c], n)])
        if whole < n:
            self.place((doc_id, whole, ids[whole:], n))

    def close(self) -> None:
        """Fill sequences from the windows that are left, fullest first, cutting pieces."""
        todo = [p for level in reversed(self.open) for pieces in level for p in pieces]
        left = self.drained = sum(len(p[2]) for p in todo)

        def next_room() -> int:
            return min(self.capacity, 1 << (left.bit_length() - 1)) if left else 0

        room, pieces = next_room(), []
        for doc_id, start, ids, n in todo:
            while len(ids):
                part = ids[:room]
                pieces.append((doc_id, start, part, n))
                start, ids, room, left = start + len(part), ids[len(part) :], room - len(part), left - len(part)
                if room == 0:
                    self.emit(pieces)
                    room, pieces = next_room(), []


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 0,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """One row per piece: id, ``start``, ``ids`` (little-endian 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset``.

    ``tokenizer`` is the vocabulary's path on the executors (None: the installed one).
    Sequence ids hold the task's partition above bit 32.
    """
    kept = docs.select(F.col(id_col), F.col(text).cast("string").alias("_body"))
    schema = T.StructType(
        [
            kept.schema.fields[0],
            T.StructField("start", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bytebpe.load(tokenizer)
        end = np.array([end_id], dtype="<u4")
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        kind: list[pa.DataType] = []

        def emit(pieces: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for doc_id, start, ids, n in pieces:
                rows.append((doc_id, start, ids.tobytes(), n, number, offset))
                offset += len(ids)
            number += 1

        def batch_of(some: list[tuple]) -> pa.RecordBatch:
            types = [kind[0], pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        packer = SumOfSquares(capacity, emit, most_open)
        for batch in batches:
            kind[:] = [batch.schema.field(0).type]
            for doc_id, body in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), np.concatenate([encoder.ids(body.as_py() or ""), end]))
                while len(rows) >= _OUT_ROWS:
                    yield batch_of(rows[:_OUT_ROWS])
                    del rows[:_OUT_ROWS]
        packer.close()
        for at in range(0, len(rows), _OUT_ROWS):
            yield batch_of(rows[at : at + _OUT_ROWS])
        rows.clear()
        release()

    return kept.mapInArrow(run, schema)


def piece_digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with ``length`` and ``ids_crc32`` in place of their ids."""
    return pieces.select(
        id_col,
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
