"""Sum-of-squares online packing of token sequences.

Each task packs the documents it reads, one after the other, into windows of a
fixed number of tokens. Windows in work are known by their fill level only: the
level array counts how many stand at each. A document goes to the level (or to a
new window) that leaves the smallest sum of squared counts. What is longer than
a window first gives off whole windows. When the input ends, the windows still
open fill each other up by cutting the emptiest, so a task leaves at most one
window that needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.encoders import encoder

WINDOW = 1024

#: Follows each document's own ids.
END = 0

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`,
    `offset`, `ids`.

    A document is its ids with an id 0 behind them; a null or empty text is that one id.
    start counts the document's ids before the piece, offset the sequence's; ids
    holds unsigned little-endian 32-bit ids, ids_crc32 is their checksum. Pieces
    of a sequence follow one another without gaps. Null ids are kept; repeated
    rows are packed each. No rows give no rows. Other columns are ignored.
    Sequence ids are unique but not consecutive.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pack(tokenizer, window), PIECES)


class Levels:
    """Windows in work by fill level."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]

    def place(self, piece: tuple) -> list | None:
        """Add a piece (doc, start, ids, doc_tokens) shorter than a window; returns the window if it is full now."""
        size, w = len(piece[2]), self.window
        level = self._level(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == w:
            return pieces
        self.count[level + size] += 1
        self.open[level + size].append(pieces)
        return None

    def _level(self, size: int) -> int:
        """The level from which adding `size` makes the sum of squares smallest; the fullest on a tie; 0 is a new window."""
        levels = np.flatnonzero(self.count[: self.window - size + 1])
        best, change = 0, 2 * self.count[size] + 1
        if len(levels):
            to = levels + size
            gain = np.where(to < self.window, 2 * self.count[to] + 1, 0) - (2 * self.count[levels] - 1)
            at = len(gain) - 1 - int(np.argmin(gain[::-1]))
            if gain[at] <= change:
                best = int(levels[at])
        return best

    def close(self) -> Iterator[list]:
        """The windows still open, filled up with pieces of the emptiest; only the last may be short."""
        left = [pieces for level in reversed(self.open) for pieces in level]
        fills = [sum(len(p[2]) for p in pieces) for pieces in left]
        i, j = 0, len(left) - 1
        while i <= j:
            while fills[i] < self.window and j > i:
                doc, start, ids, total = left[j].pop()
                cut = min(len(ids), self.window - fills[i])
                left[i].append((doc, start, ids[:cut], total))
                fills[i] += cut
                fills[j] -= cut
                if cut < len(ids):
                    left[j].append((doc, start + cut, ids[cut:], total))
                if not left[j]:
                    j -= 1
            yield left[i]
            i += 1


def _pack(tokenizer: str, window: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, levels = encoder(tokenizer), Levels(window)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def put(pieces: list) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in pieces:
                raw = ids.tobytes()
                rows.append((doc, start, len(ids), zlib.crc32(raw), total, number, offset, raw))
                offset += len(ids)
            number += 1

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            )

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(own.ids(text.as_py()), END).astype("<u4")
                whole = len(ids) - len(ids) % window
                for start in range(0, whole, window):
                    put([(doc, start, ids[start : start + window], len(ids))])
                if whole < len(ids):
                    full = levels.place((doc, whole, ids[whole:], len(ids)))
                    if full:
                        put(full)
                if len(rows) >= 4096:
                    yield flush()
        for pieces in levels.close():
            put(pieces)
            if len(rows) >= 4096:
                yield flush()
        if rows:
            yield flush()

    return pack
