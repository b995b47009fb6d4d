"""Packing whole documents into windows by exact complements.

Which documents share a window depends on their lengths only, and there are no more
lengths than tokens in a window. So tasks tokenize and count lengths; one table of at
most `window` counts decides how often which lengths go together; and each piece finds
its window from its rank among the pieces of its length. Ranks come from places inside
tasks and running totals over tasks, so no task sees all pieces of a hot length.

The plan takes lengths from the longest down. The gap it leaves is looked up among the
sums of one, two and three lengths still in stock; a combination that fills the gap is
used as often as stock allows. Where none does, the longest length that fits goes in
and the smaller gap is looked up again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.encoders import encoder
from llm.packing import END
from llm.tables import stored

WINDOW = 2048

#: Pieces in one Arrow batch on the way out of the tokenizer.
FLUSH = 4096

PIECES = "part long, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
PLAN = "length long, first long, last long, each long, offset long, base long"


def pack_best_fit(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    window: int = WINDOW,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` and, if kept, `ids`.

    A document is its ids with an id 0 behind them; a null or empty text is that one
    id. A document longer than a window is cut into windows, the first piece taking
    what is left over; all others stay whole. Sequences hold `window` ids at most,
    their pieces follow one another from offset 0 without gaps, and their numbers
    run from 0. ids holds unsigned little-endian 32-bit ids, ids_crc32 their checksum.

    Null ids are kept; repeated rows are packed each. No rows give no rows. Other columns are ignored.
    """
    if window < 1:
        raise ValueError(f"a window holds at least one id, not {window}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kept = ", ids binary" if keep_ids else ""
    pieces = stored(rows.mapInArrow(_cut(tokenizer, window, keep_ids), PIECES + kept), "pieces")

    held = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    held = stored(held, "lengths")
    # As many rows as there are lengths: `window` at most.
    counts = held.groupBy("length").agg(F.sum("n").cast("long").alias("n")).coalesce(1)
    plan = stored(counts.mapInArrow(_plan(window), PLAN), "plan")

    so_far = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("part", "length", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    table = plan.orderBy("length", "first").toArrow()
    known = docs.sparkSession.sparkContext.broadcast([table[c].to_numpy() for c in table.column_names])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    placed = "doc_id long, piece int, start long, length long, ids_crc32 long" + kept + ", sequence_id long, offset long"
    return ranked.select(*columns, "rank").mapInArrow(_place(known, columns), placed)


def _cut(tokenizer: str, window: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        rows: list[tuple] = []
        names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "nth", *(["ids"] if keep_ids else [])]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(own.ids(text.as_py()), END).astype("<u4")
                cuts = [0, *range(len(ids) % window or window, len(ids) + 1, window)]
                if cuts[-1] < len(ids):
                    cuts.append(len(ids))
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    raw = ids[a:b].tobytes()
                    row = (part, doc, i, a, b - a, zlib.crc32(raw), int(seen[b - a]))
                    rows.append((*row, raw) if keep_ids else row)
                    seen[b - a] += 1
                if len(rows) >= FLUSH:
                    yield flush()
        if rows:
            yield flush()

    return cut


def _plan(window: int):
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stock = np.zeros(window + 1, np.int64)
        for batch in batches:
            stock[batch.column("length").to_numpy()] += batch.column("n").to_numpy()
        rows = lay_out(patterns(stock))
        names = ["length", "first", "last", "each", "offset", "base"]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return plan


class Stock:
    """How many pieces of each length are left, and which sums of two lengths they can make."""

    def __init__(self, counts: np.ndarray):
        self.window = len(counts) - 1
        self.left = counts.astype(np.int64).copy()
        self.there = self.left > 0
        self.there[0] = False
        # pairs[s]: unordered pairs of lengths in stock, equal ones included, whose sum is s.
        self.pairs = np.zeros(self.window + 1, np.int64)
        for x in np.flatnonzero(self.there):
            self._pairs(int(x), 1, int(x))

    def _pairs(self, x: int, sign: int, low: int) -> None:
        """Count the pairs of x with lengths from `low` on in or out."""
        top = self.window - x
        if top >= low:
            self.pairs[x + low : self.window + 1] += sign * self.there[low : top + 1]

    def take(self, need: dict[int, int]) -> int:
        """Use up a combination as often as it can be had; how often that is."""
        times = min(int(self.left[x]) // n for x, n in need.items())
        for x, n in need.items():
            self.left[x] -= times * n
            if not self.left[x]:
                self._pairs(x, -1, 1)
                self.there[x] = False
        return times

    def fits(self, need: dict[int, int], more: tuple[int, ...]) -> bool:
        return all(self.left[x] >= need.get(x, 0) + more.count(x) for x in set(more))

    def complement(self, gap: int, need: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap, besides what is needed already; long ones first."""
        if self.there[gap] and self.fits(need, (gap,)):
            return (gap,)
        found = self._pair(gap, need, ())
        if found:
            return found
        # A third length, and a pair from the index for the rest.
        third = np.arange(gap - 2, 0, -1)
        third = third[self.there[third] & (self.pairs[gap - third] > 0)]
        for x in third:
            found = self._pair(gap - int(x), need, (int(x),))
            if found:
                return found
        return None

    def _pair(self, gap: int, need: dict[int, int], more: tuple[int, ...]) -> tuple[int, ...] | None:
        if gap < 2 or not self.pairs[gap]:
            return None
        long = np.arange(gap - 1, (gap - 1) // 2, -1)
        for x in long[self.there[long] & self.there[gap - long]]:
            found = (*more, int(x), gap - int(x))
            if self.fits(need, found):
                return found
        return None

    def longest(self, gap: int, need: dict[int, int]) -> int:
        """The longest length up to the gap that is in stock besides what is needed; 0 for none."""
        for x in np.flatnonzero(self.there[: gap + 1])[::-1]:
            if self.fits(need, (int(x),)):
                return int(x)
        return 0


def patterns(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Which lengths share a window how often, from the number of pieces of each length: ({length: pieces}, times)."""
    stock, out = Stock(counts), []
    for top in range(stock.window, 0, -1):
        while stock.left[top]:
            need, gap = {top: 1}, stock.window - top
            while gap:
                more = stock.complement(gap, need)
                if more is None:
                    best = stock.longest(gap, need)
                    more = (best,) if best else ()
                if not more:
                    break
                for x in more:
                    need[x] = need.get(x, 0) + 1
                gap -= sum(more)
            out.append((need, stock.take(need)))
    return out


def lay_out(found: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank behind the last, pieces a window, offset, first window) for each pattern's lengths."""
    rows, used, base = [], {}, 0
    for need, times in found:
        offset = 0
        for length, each in sorted(need.items(), reverse=True):
            first = used.get(length, 0)
            rows.append((length, first, first + each * times, each, offset, base))
            used[length] = first + each * times
            offset += each * length
        base += times
    return rows


def _place(known, columns: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first, _, each, offset, base = known.value
        starts = {}
        for at, length in enumerate(lengths.tolist()):
            starts.setdefault(length, [at, at])[1] = at + 1
        for batch in batches:
            own, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.zeros(len(own), np.int64)
            for length in np.unique(own).tolist():
                a, b = starts[length]
                who = np.flatnonzero(own == length)
                row[who] = a + np.searchsorted(first[a:b], rank[who], "right") - 1
            turn = rank - first[row]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(base[row] + turn // each[row]),
                    pa.array(offset[row] + turn % each[row] * own),
                ],
                [*columns, "sequence_id", "offset"],
            )

    return place
