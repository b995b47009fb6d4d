"""Alignment of two tokenizers by divide and conquer at shared cuts.

Both tokenizers spell the same bytes. Where a token of each ends at the same
byte, the text can be cut. An interval of tokens looks for such a common end near
its middle, by bisecting the other side's ends, and both halves go on alone; an
interval without one is a group. All intervals of many texts that are at work at
once take each step together, in numpy.

Within a group, tokens that overlap are linked. How many documents hold a pair
of ids linked is counted over the corpus: per task, then by pair. The commonest
pairs, HOT at most, are looked up in a broadcast table; the others are joined, which
is even, since each of them is held by fewer documents than any pair of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textbits
from llm.encoders import encoder, token_bytes
from llm.tables import stored

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Pairs in the broadcast table at most, 16 bytes each.
HOT = 1_000_000

#: Ends on each side of the middle that all intervals try together; who finds none looks further alone.
PROBES = 8

#: What can follow an id in the written form of groups.
SIGNS = (",", "|", ";", "")

#: Text bytes aligned together; a longer single text is aligned alone.
BLOCK_BYTES = 1 << 19

#: Distinct pairs that a task holds before it hands on its counts.
HELD = 1 << 20

#: What can be asked for besides the numbers, and its type.
OUTPUTS = {
    "groups": "string",
    "groups_sha256": "string",
    "a_ids": "binary",
    "b_ids": "binary",
    "a_cuts": "binary",
    "b_cuts": "binary",
}


def align_tokenizers(
    docs: DataFrame,
    tokenizer_a: str = TOKENIZER_A,
    tokenizer_b: str = TOKENIZER_B,
    outputs: Sequence[str] = ("groups",),
    hot: int = HOT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and the `outputs` of each row of `docs`.

    A encodes a space and the text (a byte-level BPE), B the text, before which it
    puts that space itself (a sentencepiece model). Strings of special tokens are
    plain text. n_links counts pairs of overlapping tokens, count_sum adds up over
    them how many rows of `docs` hold their ids linked, n_best counts those for
    which no other partner of the A id is held by more rows.

    Outputs: groups as `a1,a2|b1;a3|b2,b3` or its SHA-256 in hex; the ids, and the
    numbers of the tokens behind each group's last, as little-endian 32-bit values.

    Texts that are null or empty, or that either side's tokens don't spell, have no
    tokens: zeros, '' (unhashed) and no bytes. Each row is a document, also if it is
    repeated or its id null. No rows give no rows. Other columns are ignored.
    """
    names = _names(tokenizer_a, tokenizer_b)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    extra = "".join(f", {name} {OUTPUTS[name]}" for name in outputs)
    aligned = stored(
        rows.mapInArrow(
            _align(names, list(outputs)),
            "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, link_a binary, link_b binary" + extra,
        ),
        "aligned",
    )
    pairs = _Pairs(*(len(token_bytes(name)) for name in names))
    counted = aligned.select("n_links", "link_a", "link_b").mapInArrow(_count(pairs), "code long, n long")
    counted = stored(counted.groupBy("code").agg(F.sum("n").alias("n")), "pairs")

    floor = _hot_floor(counted, hot)
    top = counted.where(F.col("n") >= floor).toArrow()
    order = np.argsort(top["code"].to_numpy())
    # A row per id of tokenizer A that occurs.
    most = counted.groupBy(F.expr(f"code div {pairs.size_b}").alias("a")).agg(F.max("n").alias("most"))
    highest = most.toArrow()
    best = np.zeros(pairs.all // pairs.size_b, np.int64)
    best[highest["a"].to_numpy()] = highest["most"].to_numpy()
    known = docs.sparkSession.sparkContext.broadcast((top["code"].to_numpy()[order], top["n"].to_numpy()[order], best))
    scored = aligned.mapInArrow(
        _score(pairs, known, list(outputs)),
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
        + extra + ", cold array<struct<code:long,times:long>>",
    )
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *outputs]
    if floor == 1:  # every pair is in the table
        return scored.select(*result)
    scored = stored(scored, "scored")
    # The ids of tokenizer A bound `most`.
    rest = counted.where(F.col("n") < floor).withColumn("a", F.expr(f"code div {pairs.size_b}"))
    rest = rest.join(F.broadcast(most), "a").select("code", "n", (F.col("n") == F.col("most")).alias("top"))
    sums = scored.select("row", F.inline("cold")).join(rest, "code").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_count"),
    )
    both = scored.join(sums, "row", "left")
    both = both.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
    both = both.withColumn("count_sum", F.col("count_sum") + F.coalesce("more_count", F.lit(0)))
    return both.select(*result)


def _names(a: str, b: str) -> tuple[str, str]:
    if a.endswith(".model") or not b.endswith(".model"):
        raise ValueError("tokenizer_a is a byte-level .json file, tokenizer_b a .model file")
    return a, b


def _hot_floor(counted: DataFrame, hot: int) -> int:
    """The smallest power of two that at most `hot` pairs reach with their counts."""
    power = F.floor(F.log2("n")).cast("int")
    found = dict(counted.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("pairs")).collect())  # 63 rows at most
    taken, floor = 0, 1 << 62
    for p in range(61, -1, -1):
        taken += found.get(p, 0)
        if taken > hot:
            break
        floor = 1 << p
    return floor


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """The groups (a_lo, a_hi, b_lo, b_hi), in order, of intervals of tokens given likewise.

    Ends ascend over all texts; each span's last ends are equal.
    """
    todo, leaves = spans, []
    while len(todo):
        a_lo, a_hi, b_lo, b_hi = todo.T
        # The side with fewer tokens offers its ends; only inner ones can cut.
        fewer = (a_hi - a_lo) <= (b_hi - b_lo)
        lo, hi = np.where(fewer, a_lo, b_lo), np.where(fewer, a_hi, b_hi) - 1
        at = np.full(len(todo), -1)
        other = np.zeros(len(todo), np.int64)
        live = np.flatnonzero(hi > lo)
        middle = (lo + hi - 1) >> 1
        for step in range(2 * PROBES + 1):
            if not len(live):
                break
            here = middle[live] + ((step + 1) // 2) * (1 if step % 2 else -1)
            valid = (here >= lo[live]) & (here < hi[live])
            who, here = live[valid], here[valid]
            match, place = _bisect(ends_a, ends_b, fewer[who], here)
            at[who[match]], other[who[match]] = here[match], place[match]
            live = live[at[live] < 0]
        for i in live:
            if hi[i] - lo[i] > 2 * PROBES:
                at[i], other[i] = _far(*((ends_a, ends_b) if fewer[i] else (ends_b, ends_a)), lo[i], hi[i], middle[i])
        found = at >= 0
        leaves.append(todo[~found])
        cut, fewer, at, other = todo[found], fewer[found], at[found] + 1, other[found] + 1
        cut_a, cut_b = np.where(fewer, at, other), np.where(fewer, other, at)
        halves = np.stack([cut[:, 0], cut_a, cut[:, 2], cut_b, cut_a, cut[:, 1], cut_b, cut[:, 3]], 1).reshape(-1, 4)
        # A single token on a side has no end inside.
        single = (halves[:, 1] - halves[:, 0] == 1) | (halves[:, 3] - halves[:, 2] == 1)
        leaves.append(halves[single])
        todo = halves[~single]
    groups = np.concatenate(leaves) if leaves else np.zeros((0, 4), np.int64)
    return groups[np.argsort(groups[:, 0])]


def _bisect(ends_a: np.ndarray, ends_b: np.ndarray, fewer: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the end at `here` of one side (A where `fewer`) is an end of the other, and where."""
    place = np.zeros(len(here), np.int64)
    match = np.zeros(len(here), bool)
    for side, (own, other) in ((fewer, (ends_a, ends_b)), (~fewer, (ends_b, ends_a))):
        who = np.flatnonzero(side)
        if len(who):
            wanted = own[here[who]]
            place[who] = np.searchsorted(other, wanted)
            match[who] = other[np.minimum(place[who], len(other) - 1)] == wanted
    return match, place


def _far(own: np.ndarray, other: np.ndarray, lo: int, hi: int, middle: int) -> tuple[int, int]:
    """The common end nearest to the middle beyond the first probes, in windows that double; -1 for none."""
    reach = PROBES
    while True:
        reach *= 2
        a, b = max(lo, middle - reach), min(hi, middle + reach + 1)
        place = np.searchsorted(other, own[a:b])
        hits = np.flatnonzero(other[np.minimum(place, len(other) - 1)] == own[a:b])
        if len(hits):
            best = hits[np.argmin(np.abs(hits + a - middle))]
            return int(best + a), int(place[best])
        if a == lo and b == hi:
            return -1, 0


def links(ends_a: np.ndarray, ends_b: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the tokens of each overlapping pair, in order.

    Inside a group no inner end is shared: a walk over both sides' ends meets a new pair at each of them.
    """
    if not len(groups):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last_b = np.zeros(len(ends_b), bool)
    last_b[groups[:, 3] - 1] = True
    steps = np.sort(np.concatenate([ends_a, ends_b[~last_b]]))
    return np.searchsorted(ends_a, steps), np.searchsorted(ends_b, steps)


def _align(names: tuple[str, str], outputs: list[str]):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        sides = [_Side(name) for name in names]
        texts = [f"{i}{sign}" for side in sides for i in range(len(side.bytes)) for sign in SIGNS]
        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text")
            for lo, hi, _, _ in textbits.blocks(text, BLOCK_BYTES):
                yield _aligned(ids.slice(lo, hi - lo), text.slice(lo, hi - lo).to_pylist(), sides, outputs, row, texts)
                row += hi - lo

    return align


class _Side:
    """A tokenizer with the bytes of its ids."""

    def __init__(self, name: str):
        self.encoder, self.bytes = encoder(name, plain=True), token_bytes(name)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.kind = np.dtype("<u2" if len(self.bytes) <= 1 << 16 else "<u4")

    def spelled(self, text: str, data: bytes) -> np.ndarray | None:
        ids = self.encoder.ids(text)
        known = self.bytes
        return ids if b"".join([known[i] for i in ids.tolist()]) == data else None


def _aligned(ids: pa.Array, text: list, sides: list[_Side], outputs: list[str], row: int, texts: list[str]) -> pa.RecordBatch:
    a, b = sides
    parts_a, parts_b = [], []
    none = np.zeros(0, np.uint32)
    for own in text:
        spaced = f" {own}" if own else ""
        data = spaced.encode()
        one = a.spelled(spaced, data) if own else None
        two = b.spelled(own, data) if one is not None else None
        parts_a.append(none if two is None else one)
        parts_b.append(none if two is None else two)
    n_a, n_b = (np.array([len(p) for p in parts], np.int64) for parts in (parts_a, parts_b))
    ids_a, ids_b = (np.concatenate(p).astype(np.int64) for p in (parts_a, parts_b))
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    spans = np.stack([stop_a - n_a, stop_a, stop_b - n_b, stop_b], 1)[n_a > 0]
    groups = common_cuts(ends_a, ends_b, spans)
    link_a, link_b = links(ends_a, ends_b, groups)
    n_groups = np.diff(np.concatenate([[0], np.searchsorted(groups[:, 1], stop_a, "right")]))
    n_links = n_a + n_b - n_groups

    def packed(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
        return textbits.binary(values.astype(kind), counts)

    columns = {
        "row": pa.array(np.arange(row, row + len(text))),
        "doc_id": ids,
        "n_a": pa.array(n_a),
        "n_b": pa.array(n_b),
        "n_groups": pa.array(n_groups),
        "n_links": pa.array(n_links),
        "link_a": packed(ids_a[link_a], n_links, a.kind),
        "link_b": packed(ids_b[link_b], n_links, b.kind),
    }
    if "groups" in outputs or "groups_sha256" in outputs:
        written = _written(ids_a, ids_b, groups, a, n_a + n_b, texts)
        columns["groups"] = pa.array(written)
        if "groups_sha256" in outputs:
            columns["groups_sha256"] = pa.array([hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written])
    if "a_ids" in outputs:
        columns["a_ids"] = packed(ids_a, n_a, "<u4")
    if "b_ids" in outputs:
        columns["b_ids"] = packed(ids_b, n_b, "<u4")
    if "a_cuts" in outputs:
        columns["a_cuts"] = packed(groups[:, 1] - np.repeat(stop_a - n_a, n_groups), n_groups, "<u4")
    if "b_cuts" in outputs:
        columns["b_cuts"] = packed(groups[:, 3] - np.repeat(stop_b - n_b, n_groups), n_groups, "<u4")
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "link_a", "link_b", *outputs]
    return pa.RecordBatch.from_arrays([columns[name] for name in names], names)


def _written(ids_a, ids_b, groups, a: _Side, counts: np.ndarray, texts: list[str]) -> list[str]:
    """Each text's groups, the A ids before the B ids of each.

    `texts` is how each id of A, then of B, is written before each of the signs.
    """
    sign_a, sign_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    sign_a[groups[:, 1] - 1], sign_b[groups[:, 3] - 1] = SIGNS.index("|"), SIGNS.index(";")
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + np.repeat(groups[:, 2], groups[:, 1] - groups[:, 0])] = len(SIGNS) * ids_a + sign_a
    codes[np.arange(len(ids_b)) + np.repeat(groups[:, 1], groups[:, 3] - groups[:, 2])] = (
        len(SIGNS) * (len(a.bytes) + ids_b) + sign_b
    )
    ends = np.cumsum(counts)
    # The last of each text, a B token, has no sign behind it.
    codes[ends[counts > 0] - 1] += SIGNS.index("") - SIGNS.index(";")
    return ["".join(map(texts.__getitem__, codes[end - n : end].tolist())) for end, n in zip(ends.tolist(), counts.tolist())]


class _Pairs:
    """How pairs of ids are packed in stored columns, and one number for each."""

    def __init__(self, size_a: int, size_b: int):
        self.size_b, self.kinds = size_b, [np.dtype("<u2" if n <= 1 << 16 else "<u4") for n in (size_a, size_b)]
        self.all = size_a * size_b

    def chunks(self, batch: pa.RecordBatch, limit: int = HELD) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, codes of their links, number of links of each row)."""
        counts = batch.column("n_links").to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            a, b = (
                np.frombuffer(b"".join(batch.column(c).slice(at, end - at).to_pylist()), kind).astype(np.int64)
                for c, kind in zip(("link_a", "link_b"), self.kinds)
            )
            yield at, end, a * self.size_b + b, counts[at:end]
            at = end


def _merged(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _count(pairs: _Pairs):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting, size = [], 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            return _merged(np.concatenate([held[0], *(w[0] for w in waiting)]), np.concatenate([held[1], *(w[1] for w in waiting)]))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["code", "n"])

        for batch in batches:
            for _, _, codes, counts in pairs.chunks(batch):
                own = np.unique(np.repeat(np.arange(len(counts)) * pairs.all, counts) + codes) % pairs.all
                waiting.append(np.unique(own, return_counts=True))
                size += len(waiting[-1][0])
                if size > HELD:
                    held, waiting, size = merge(), [], 0
                    if len(held[0]) > HELD:
                        yield out()
                        held = (held[0][:0], held[1][:0])
        held = merge()
        yield out()

    return count


def _score(pairs: _Pairs, known, outputs: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_n, best = known.value
        for batch in batches:
            for lo, hi, codes, counts in pairs.chunks(batch):
                place = np.minimum(np.searchsorted(hot, codes), max(len(hot) - 1, 0))
                found = hot[place] == codes if len(hot) else np.zeros(len(codes), bool)
                n = np.where(found, hot_n[place], 0) if len(hot) else np.zeros(len(codes), np.int64)
                top = found & (n == best[codes // pairs.size_b])
                ends = np.cumsum(counts)
                sums = [np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(x)])[ends]])) for x in (top, n)]
                owner = np.repeat(np.arange(len(counts)), counts)[~found]
                cold, times = np.unique(owner * pairs.all + codes[~found], return_counts=True)
                rest = pa.StructArray.from_arrays(
                    [pa.array(cold % pairs.all), pa.array(times.astype(np.int64))], ["code", "times"]
                )
                starts = np.searchsorted(cold // pairs.all, np.arange(len(counts) + 1))
                part = batch.slice(lo, hi - lo)
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), *(pa.array(x.astype(np.int64)) for x in sums),
                     *(part.column(c) for c in outputs), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rest)],
                    [*names, "n_best", "count_sum", *outputs, "cold"],
                )

    return score
