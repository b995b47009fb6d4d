"""Substring dedup by collinear chaining of shared k-mer seeds.

Seeds are minimizers: of any 16 consecutive 5-word windows the one with the
smallest hash, so two texts with 20 equal words in a row share a seed. Two seeds that
follow one another and both occur in several documents are, with their distance, a seed too. Each seed is joined to its first
occurrence only (the smallest document id), so a passage in a third of all documents
costs one match per occurrence. Single seeds of a passage may all have first occurrences
in different documents, as phrases that many texts use; seeds of two still match in pairs
with one document, so what repeats word for word is covered. The matches of two
documents are chained in order, gaps costing a little for each word skipped, by
a Fenwick tree of best prefixes; chains are aligned word by word and stretched
beyond their outer seeds. What the aligned parts of a document cover together,
whatever their sources, is a passage if it is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textbits
from llm.tables import stored

#: Words of a seed, and windows of which one becomes a seed.
SEED, SPACING = 5, 16

#: A match's place is STEPS times the word's number, plus the words to the second seed for a seed of two.
STEPS = 32

#: Factors that mix the parts of a seed of two; any odd numbers.
PAIRED = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

#: Words a passage has at least; part of its words that the alignment must match.
MIN_WORDS, SIMILARITY = 50, 0.8

#: A seed's worth in words skipped on both sides together: longer gaps start a new chain.
REACH = 64

#: Words around a chain that the alignment may take in (around seeds of two SPACING are enough, as the next
#: ones follow within them), and words between passages that count as one.
MARGIN, JOIN = 64, 2

#: Pairs of word sequences aligned in one batch; bytes of sequences cut out in one.
PAIRS, CUT_BYTES = 64, 1 << 22

#: Ranges of one text that a task cuts out.
RANGES = 10_000

#: A stretch between seeds that matches less than half breaks the alignment from so many words on.
BREAK = 8


def find_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Passages of `min_words` words or more that a document with a smaller id holds too, wholly or in parts.

    `doc_id`, `start_word`, `end_word` (exclusive), `n_words`, `matched` (words that
    align), `source_ids` (ascending; without documents whose part lies within that of an
    earlier one). Words are runs of characters other than 0x20 and 0x09-0x0D, compared with A-Z lower-cased. The first document to hold a
    passage has no row for it; a repeat inside one document is none.

    What repeats word for word over `min_words` + 2 * (SPACING - 1) words is always found, but for SPACING - 1
    words at its ends at most. Shorter repeats are as a rule: they may be missed if their seeds first occur in
    documents that hold less of them.

    Rows with a null id or text, or fewer words, have no passage. Of repeated rows
    with one id the passages are given once; they are no repeats of each other. No
    rows give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id is not null and text is not null")
    seeds = stored(rows.mapInArrow(_seeds, "seed long, doc long, at long"), "seeds")
    repeated = stored(_with_firsts(seeds, "seed", "doc", "at", "src", "src_at"), "repeated")
    word = f"({{}} & {2**32 - 1}) * {STEPS}L"
    singles = repeated.where("doc > src").selectExpr("doc", "src", f"{word.format('at')} as at", f"{word.format('src_at')} as src_at")
    # Where both seeds of two occur elsewhere too: few, in texts that repeat little.
    couples = repeated.select("seed", "doc", "at").repartition("doc").sortWithinPartitions("doc", "at")
    couples = stored(couples.mapInArrow(_couples, "seed long, doc long, at long"), "couples")
    couples = _with_firsts(couples, "doc", "at", "src", "src_at").where("doc > src")
    matches = singles.unionByName(couples)
    matches = matches.repartition("doc").sortWithinPartitions("doc", "src", "at", "src_at")
    chains = stored(
        matches.mapInArrow(
            _chains(min_words), "doc long, src long, chain int, margin int, lo int, hi int, src_lo int, src_hi int, ats binary, src_ats binary"
        ),
        "chains",
    )
    ends = "stack(2, 0, doc, lo, hi, 1, src, src_lo, src_hi) as (side, doc_id, lo, hi)"
    wanted = chains.selectExpr("doc", "src", "chain", "margin", ends)
    cut = _beside_texts(wanted, rows).mapInArrow(_slices, "doc long, src long, chain int, side int, base int, words binary")
    cut = stored(cut, "slices")
    key = ["doc", "src", "chain"]
    left = cut.where("side = 0").drop("side")
    right = cut.where("side = 1").drop("side").toDF(*key, "src_base", "src_words")
    pairs = chains.select(*key, "ats", "src_ats").join(left, key).join(right, key)
    spans = pairs.mapInArrow(_align, "doc long, src long, start int, end int, matched int")
    # Rows that hold the words of two long texts: few at once.
    spans = stored(spans, "spans", PAIRS).repartition("doc").sortWithinPartitions("doc", "start", F.desc("end"), "src")
    return spans.mapInArrow(
        _passages(min_words),
        "doc_id long, start_word int, end_word int, n_words int, matched int, source_ids array<long>",
    )


def _with_firsts(seeds: DataFrame, *columns: str) -> DataFrame:
    """Seeds that several documents hold, each beside its first occurrence."""
    firsts = seeds.groupBy("seed").agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last"))
    firsts = firsts.where("first.doc < last").select("seed", F.col("first.doc").alias("src"), F.col("first.at").alias("src_at"))
    return seeds.join(firsts, "seed").select(*columns)


def _beside_texts(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts, each followed by the ranges wanted of it, so that a task hashes a text once for all its ranges.

    Of a document many others copy from, ranges are dealt to as many tasks as it takes, each with the text.
    """
    hot = wanted.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / RANGES).cast("int").alias("parts")).where("parts > 1")
    hot = stored(hot, "hot")
    parts = F.coalesce("parts", F.lit(1))
    asked = wanted.join(hot, "doc_id", "left").select(
        "doc_id", F.pmod(F.xxhash64("doc", "src", "chain", "side"), parts).cast("int").alias("part"), F.lit(1).alias("kind"),
        "doc", "src", "chain", "margin", "side", "lo", "hi", F.lit(None).cast("string").alias("text"),
    )
    none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("doc", "src", "chain", "margin", "side", "lo", "hi")]
    texts = rows.join(hot, "doc_id", "left").select(
        "doc_id", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("kind"), *none, "text"
    )
    return asked.union(texts).repartition("doc_id", "part").sortWithinPartitions("doc_id", "part", "kind")


def drop_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs`, columns as they are, without the words of `find_passages`; n_chars, if there, follows the text.

    Documents of which nothing is left go; all others stay, untouched if they hold no such passage.
    """
    names, own = docs.columns, "spans"
    while own in names or f"{own}_of" in names:
        own += "_"
    found = find_passages(docs, min_words=min_words).groupBy(F.col("doc_id").alias(f"{own}_of")).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias(own)
    )
    # Merged at every size: a table of spans that fits a broadcast today may not tomorrow.
    joined = docs.join(found.hint("merge"), docs["doc_id"] == found[f"{own}_of"], "left").drop(f"{own}_of")
    left = joined.mapInArrow(_without(names, own), docs.schema)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else left


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for lo, _, data, offsets in textbits.blocks(batch.column("text")):
            hashes, _, _, bounds = textbits.words(data, offsets)
            windows = textbits.shingle_windows(hashes, SEED)
            chosen = np.zeros(len(windows), bool)
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a >= SEED:
                    chosen[a + minimizers(windows[a : b - SEED + 1])] = True
            at = np.flatnonzero(chosen)
            doc = np.searchsorted(bounds, at, "right") - 1
            # The rightmost of several texts that start here is the one with words. A place is the
            # seed's number in its text, above the number of its first word.
            number = np.arange(len(at)) - np.searchsorted(doc, doc)
            place = (number << 32) + at - bounds[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows[at].view(np.int64)), pa.array(ids[lo + doc]), pa.array(place)], ["seed", "doc", "at"]
            )


def _couples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of two: both hashes and the words between their starts, for seeds that follow one another in a text."""
    for table in _groups(batches, ["doc"]):
        seed, doc, at = (table.column(c).to_numpy() for c in ("seed", "doc", "at"))
        step = (at[1:] & 0xFFFFFFFF) - (at[:-1] & 0xFFFFFFFF)
        both = np.flatnonzero((doc[1:] == doc[:-1]) & ((at[1:] >> 32) == (at[:-1] >> 32) + 1) & (step > 0) & (step < STEPS))
        step, hashes = step[both], seed.view(np.uint64)
        mixed = textbits.mix(
            hashes[both] * PAIRED[0] + hashes[both + 1] * PAIRED[1] + step.astype(np.uint64) * PAIRED[2]
        )
        place = (at[both] & 0xFFFFFFFF) * STEPS + step
        yield pa.RecordBatch.from_arrays(
            [pa.array(mixed.view(np.int64)), pa.array(doc[both]), pa.array(place)], ["seed", "doc", "at"]
        )


def minimizers(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest hash (the first of equals) of each SPACING consecutive ones; of all, if fewer."""
    if len(hashes) <= SPACING:
        return np.array([int(hashes.argmin())])
    views = np.lib.stride_tricks.sliding_window_view(hashes, SPACING)
    return np.unique(np.arange(len(views)) + views.argmin(1))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of rows with equal keys, from sorted batches."""
    carry: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carry is None else pa.concat_tables([carry, table])
        if not len(table):
            continue
        other = np.zeros(len(table), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            other |= values != values[-1]
        at = np.flatnonzero(other)
        cut = int(at[-1]) + 1 if len(at) else 0
        carry = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if carry is not None and len(carry):
        yield carry


def _chains(min_words: int):
    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "src", "chain", "margin", "lo", "hi", "src_lo", "src_hi", "ats", "src_ats"]
        for table in _groups(batches, ["doc"]):
            doc, src, at, src_at = (table.column(c).to_numpy() for c in ("doc", "src", "at", "src_at"))
            cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            rows = []
            for a, b in zip(cuts, np.append(cuts[1:], len(doc))):
                number: dict[int, int] = {}
                singles, couples = _document(src[a:b], at[a:b], src_at[a:b], min_words)
                for margin, (one, x, y) in [*((MARGIN, c) for c in singles), *((SPACING, c) for c in couples)]:
                    number[one] = number.get(one, -1) + 1
                    rows.append(
                        (doc[a], one, number[one], margin, x[0], x[-1] + SEED, y[0], y[-1] + SEED,
                         x.astype(np.int32).tobytes(), y.astype(np.int32).tobytes())
                    )
            if rows:
                kinds = [pa.int64()] * 2 + [pa.int32()] * 6 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return chains


Chain = tuple[int, np.ndarray, np.ndarray]


def _document(src: np.ndarray, at: np.ndarray, src_at: np.ndarray, min_words: int) -> tuple[list[Chain], list[Chain]]:
    """The chains (source, places, places in the source) of one document, of single seeds and of seeds of two.

    Chains of single seeds all count. Seeds of two count where no such chain has both, and only if what
    chains cover together, whatever their sources, can be a passage.
    """
    step, at, src_at = at % STEPS, at // STEPS, src_at // STEPS
    single = step == 0
    out = _by_source(src[single], at[single], src_at[single])
    steps = [x[:-1] * STEPS + np.where((np.diff(x) == np.diff(y)) & (np.diff(x) < STEPS), np.diff(x), 0) for _, x, y in out]
    pairs = np.flatnonzero(~single & ~np.isin(at * STEPS + step, np.concatenate(steps) if steps else []))
    more = _by_source(
        np.concatenate([src[pairs], src[pairs]]),
        np.concatenate([at[pairs], at[pairs] + step[pairs]]),
        np.concatenate([src_at[pairs], src_at[pairs] + step[pairs]]),
    )
    if not more:
        return out, []
    # What is covered together, whatever the sources.
    spans = [(int(x[0]), int(x[-1]) + SEED) for _, x, _ in [*out, *more]]
    order = sorted(range(len(spans)), key=lambda i: spans[i])
    kept, run, end = set(), [], -1
    for i in [*order, None]:
        if i is None or spans[i][0] > end + JOIN:
            if run and end - spans[run[0]][0] >= min_words:
                kept.update(run)
            run, end = [], -1
        if i is not None:
            end = max(end, spans[i][1])
            run.append(i)
    return out, [chain for i, chain in enumerate(more, len(out)) if i in kept]


def _by_source(src: np.ndarray, at: np.ndarray, src_at: np.ndarray) -> list[Chain]:
    """Chains of distinct matches, source by source."""
    if not len(src):
        return []
    order = np.lexsort((src_at, at, src))
    rows = np.stack([src, at, src_at])[:, order]
    fresh = np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])
    src, at, src_at = rows[:, fresh]
    cuts = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
    ends = np.append(cuts[1:], len(src))
    long = ends - cuts > 1
    return [(int(src[a]), x, y) for a, b in zip(cuts[long], ends[long]) for x, y in chain(at[a:b], src_at[a:b])]


def chain(at: np.ndarray, src_at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chains of two matches or more, ascending in both texts; `at` is ascending.

    A chain's score is a point per match less (words skipped in both texts) /
    REACH; the best end is taken first, back to where another chain has passed.
    """
    n = len(at)
    if n < 2:
        return []
    if np.all(np.diff(at) > 0) and np.all(np.diff(at) == np.diff(src_at)) and np.all(2 * np.diff(at) < REACH):
        return [(at, src_at)]  # one diagonal, as in a copy
    levels, rank = np.unique(src_at, return_inverse=True)
    best_score = [-np.inf] * (len(levels) + 1)  # Fenwick tree over places in the source
    best_match = [-1] * (len(levels) + 1)
    score, back = np.zeros(n), np.full(n, -1)
    waiting = 0  # the first match that is not in the tree
    for i in range(n):
        while waiting < i and at[waiting] < at[i]:
            j = waiting
            waiting += 1
            value, k = score[j] + (at[j] + src_at[j]) / REACH, int(rank[j]) + 1
            while k <= len(levels):
                if value > best_score[k]:
                    best_score[k], best_match[k] = value, j
                k += k & -k
        found, k, top = -1, int(rank[i]), -np.inf
        while k > 0:
            if best_score[k] > top:
                top, found = best_score[k], best_match[k]
            k -= k & -k
        gain = top - (at[i] + src_at[i]) / REACH
        score[i] = 1.0
        if found >= 0 and gain > 0:
            score[i], back[i] = 1.0 + gain, found
    used = np.zeros(n, bool)
    out = []
    for end in np.argsort(-score, kind="stable"):
        path, i = [], int(end)
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = int(back[i])
        if len(path) > 1:
            path.reverse()
            out.append((at[path], src_at[path]))
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed words of a text around each range wanted of it, and the number of the first."""
    own, texts = None, []  # the document and part at hand; the hashed words of its texts
    for batch in batches:
        ids, halves, kinds = (batch.column(c).to_numpy() for c in ("doc_id", "part", "kind"))
        lows, highs, margins = (batch.column(c).fill_null(0).to_numpy() for c in ("lo", "hi", "margin"))
        rows, parts, bases, size = [], [], [], 0
        for i, (doc, part, kind) in enumerate(zip(ids.tolist(), halves.tolist(), kinds.tolist())):
            if (doc, part) != own:
                own, texts = (doc, part), []
            if kind == 0:
                data = np.frombuffer((batch.column("text")[i].as_py() or "").encode(), np.uint8)
                texts.append(textbits.words(data, np.array([0, len(data)]))[0])
                continue
            base = max(0, int(lows[i] - margins[i]))
            for hashes in texts:
                rows.append(i)
                bases.append(base)
                parts.append(hashes[base : int(highs[i] + margins[i])].tobytes())
                size += len(parts[-1])
            if size >= CUT_BYTES:
                yield _sliced(batch, rows, bases, parts)
                rows, parts, bases, size = [], [], [], 0
        if parts:
            yield _sliced(batch, rows, bases, parts)


def _sliced(batch: pa.RecordBatch, rows: list[int], bases: list[int], parts: list[bytes]) -> pa.RecordBatch:
    keys = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc", "src", "chain", "side")]
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array(bases, pa.int32()), pa.array(parts, pa.binary())], ["doc", "src", "chain", "side", "base", "words"]
    )


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            ats, src_ats = np.frombuffer(r["ats"], np.int32) - r["base"], np.frombuffer(r["src_ats"], np.int32) - r["src_base"]
            one, two = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["src_words"], np.uint64)
            if ats[-1] + SEED > len(one) or src_ats[-1] + SEED > len(two):
                continue  # the text of another row with this id
            rows += [(r["doc"], r["src"], a + r["base"], b + r["base"], m) for a, b, m in align(one, two, ats, src_ats)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "src", "start", "end", "matched"])


def align(one: np.ndarray, two: np.ndarray, ats: np.ndarray, src_ats: np.ndarray) -> list[tuple[int, int, int]]:
    """Parts of `one` (start, end, matched words) that follow `two` along a chain of matches."""
    out = []
    i, j = int(ats[0]), int(src_ats[0])
    start, src_start, matched = i, j, 0
    for x, y in [*zip(ats.tolist(), src_ats.tolist()), (None, None)]:
        if x is not None and (x < i or y < j):
            # Overlaps what is matched: count what lies beyond, if it is on the same diagonal.
            step = min(x + SEED - i, y + SEED - j)
            if step <= 0 or x - i != y - j:
                continue
            x, y, ahead = i, j, step
        elif x is not None:
            ahead = SEED
        if x is not None:
            a, b = one[i:x], two[j:y]
            common = int((a == b).sum()) if len(a) == len(b) else _common(a, b)
            if max(len(a), len(b)) <= BREAK or 2 * common >= max(len(a), len(b)):
                matched += common + int((one[x : x + ahead] == two[y : y + ahead]).sum())
                i, j = x + ahead, y + ahead
                continue
        # The end of an aligned part: stretch it over what is alike beyond both ends.
        right, hits = _stretch(one[i:], two[j:])
        left, more = _stretch(one[:start][::-1], two[:src_start][::-1])
        length = max(i + right - start + left, j + right - src_start + left)
        total = matched + hits + more
        if total >= SIMILARITY * length:
            out.append((start - left, i + right, total))
        if x is not None:
            start, src_start = x, y
            matched = int((one[x : x + ahead] == two[y : y + ahead]).sum())
            i, j = x + ahead, y + ahead
    return out


def _stretch(one: np.ndarray, two: np.ndarray) -> tuple[int, int]:
    """Words by which to go on on the diagonal, a miss costing two hits; and the hits."""
    n = min(len(one), len(two), MARGIN)
    if not n:
        return 0, 0
    same = one[:n] == two[:n]
    total = np.cumsum(np.where(same, 1, -2))
    best = int(total.argmax())
    return (best + 1, int(same[: best + 1].sum())) if total[best] > 0 else (0, 0)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short stretches."""
    line = np.zeros(len(b) + 1, np.int64)
    for word in a:
        step = np.maximum(line[1:], np.where(b == word, line[:-1] + 1, 0))
        line[1:] = np.maximum.accumulate(step)
    return int(line[-1])


def _passages(min_words: int):
    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start_word", "end_word", "n_words", "matched", "source_ids"]
        for table in _groups(batches, ["doc"]):
            rows: list[list] = []
            widest = None  # the part that reaches farthest so far
            for doc, src, start, end, matched in zip(*(table.column(c).to_pylist() for c in ("doc", "src", "start", "end", "matched"))):
                if widest and widest[0] == doc and end <= widest[1] and src >= widest[2]:
                    continue  # adds nothing to what an earlier document covers
                if not widest or widest[0] != doc or end > widest[1]:
                    widest = (doc, end, src)
                if rows and rows[-1][0] == doc and start <= rows[-1][2] + JOIN:
                    last = rows[-1]
                    fresh = max(0, end - last[2])
                    last[2], last[3] = max(last[2], end), last[3] + min(matched, fresh)
                    last[4].add(src)
                else:
                    rows.append([doc, start, end, matched, {src}])
            rows = [r for r in rows if r[2] - r[1] >= min_words]
            columns = [
                [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[2] - r[1] for r in rows],
                [r[3] for r in rows], [sorted(r[4]) for r in rows],
            ]
            kinds = [pa.int64()] + [pa.int32()] * 4 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return passages


def _without(names: list[str], own: str):
    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            stay = np.ones(len(batch), bool)
            for i, spans in enumerate(batch.column(own).to_pylist()):
                if spans and texts[i]:
                    texts[i] = _cut_words(texts[i], [(s["start_word"], s["end_word"]) for s in spans])
                    stay[i] = bool(texts[i])
            kind = batch.schema.field("text").type
            columns = [pa.array(texts, kind) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stay))

    return without


def _cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space behind them; empty if no word is left."""
    data = np.frombuffer(text.encode(), np.uint8)
    _, starts, ends, _ = textbits.words(data, np.array([0, len(data)]))
    raw, parts, at = data.tobytes(), [], 0
    for a, b in sorted(spans):
        if a >= len(starts):
            continue
        parts.append(raw[at : starts[a]])
        at = int(starts[b]) if b < len(starts) else len(raw)
    parts.append(raw[at:])
    left = b"".join(parts).decode()
    return left.rstrip(" \t\n\v\f\r") if left.strip(" \t\n\v\f\r") else ""
