"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of two rows of a hashed table, one for the word and
one for its first bytes. Filters of several widths slide over the embeddings of
the whole text; the largest response of each goes into a logistic output. Part
of the training sample is set aside to calibrate a threshold for each language,
told by function words of the text, and scores are shifted so that the threshold
comes to lie at 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import textbits

#: Rows of the hashed table, width of an embedding, filter widths, filters of each.
ROWS, DIM, WIDTHS, FILTERS = 1 << 17, 16, (1, 2, 3), 8

#: Labelled documents learned from, at most, by label: the first by a hash of their ids.
POSITIVE, NEGATIVE = 2500, 5000

#: Steps, documents per step, step size; one in so many of the sample calibrates.
STEPS, BATCH, RATE, ASIDE = 1600, 32, 0.05, 5

#: Scores from here on predict 1.
THRESHOLD = 0.7

#: Bytes that make up a word's beginning.
HEAD = 5

#: Frequent function words. Fixed values.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine zu mit den von auf für sich",
    "en": "the of and to in is that for it was on with as be at",
    "es": "el los las una por con para del su es y en que un se",
    "fr": "le les des du une est dans pour que qui pas sur au avec et",
}

_SPLIT = np.ones(256, bool)
_SPLIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PAD = ROWS  # a row of zeros


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Whether a row's label may be learned: crc32 of its id as text, modulo 3, is not 1. A null id's is not."""
    return F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 3 != 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row of `docs`.

    Learns from at most POSITIVE and NEGATIVE labelled `training_rows`; a score
    depends on the text alone. A null or empty text is scored as one without
    words. Null labels are left out, of several labels of one id the largest
    counts. Without labels of both kinds all scores are the share of ones, or 0.
    Null ids are kept, neither held out nor learned from; repeated rows come back
    as often as they came in. No rows give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(_learn(rows, labels.select(F.col(id_col).cast("long").alias("doc_id"), "toxic")))
    held = F.coalesce(~training_rows(rows), F.lit(False)) & F.col("doc_id").isNotNull()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate([model.value.scores(*_features(d, o)) for _, _, d, o in textbits.blocks(batch.column("text"), 1 << 20)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = rows.select("doc_id", held.alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def _learn(rows: DataFrame, labels: DataFrame) -> "Model":
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(training_rows(known))
    chosen = None
    for label, most in ((1, POSITIVE), (0, NEGATIVE)):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    # At most POSITIVE + NEGATIVE ids: safe to broadcast.
    sample = rows.where("doc_id is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, heads, groups, sizes = [], [], [], []
            for _, _, data, offsets in textbits.blocks(batch.column("text")):
                word, head, bounds, group = _features(data, offsets)
                whole.append(word), heads.append(head), groups.append(group), sizes.append(np.diff(bounds))
            sizes = np.concatenate(sizes or [np.zeros(0, np.int64)])
            parts = [np.concatenate(x or [np.zeros(0, np.int32)]).astype(np.int32) for x in (whole, heads)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), textbits.binary(parts[0], sizes), textbits.binary(parts[1], sizes),
                 pa.array(np.concatenate(groups or [np.zeros(0, np.int64)]).astype(np.int32))],
                ["doc_id", "toxic", "words", "heads", "lang"],
            )

    found = sample.mapInArrow(encode, "doc_id long, toxic int, words binary, heads binary, lang int").toPandas()
    found = found.sort_values("doc_id").drop_duplicates("doc_id")
    texts = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)) for a, b in zip(found["words"], found["heads"])]
    return train(texts, found["toxic"].to_numpy(np.float64), found["lang"].to_numpy(np.int64))


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of each word and of its beginning, where texts start (n + 1), and each text's language group."""
    hashes, starts, ends, bounds = textbits.words(data, offsets, _SPLIT)
    head = np.zeros(len(starts), np.uint64)
    for j in range(HEAD):
        inside = starts + j < ends
        head[inside] |= textbits.LOWER[data[starts[inside] + j]].astype(np.uint64) << np.uint64(8 * j)
    groups = np.full((len(offsets) - 1, len(FUNCTION_WORDS)), 0)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    for i, listed in enumerate(_function_hashes()):
        at = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
        groups[:, i] = np.bincount(doc[listed[at] == hashes], minlength=len(groups))
    group = np.where(groups.any(1), groups.argmax(1), len(FUNCTION_WORDS))
    rows = np.uint64(ROWS)
    return (hashes % rows).astype(np.int32), (textbits.mix(head + np.uint64(1)) % rows).astype(np.int32), bounds, group


_FUNCTION: list[np.ndarray] = []


def _function_hashes() -> list[np.ndarray]:
    if not _FUNCTION:
        for listed in FUNCTION_WORDS.values():
            data = np.frombuffer(listed.encode(), np.uint8)
            _FUNCTION.append(np.sort(textbits.words(data, np.array([0, len(data)]), _SPLIT)[0]))
    return _FUNCTION


class Model:
    def __init__(self, table: np.ndarray, filters: dict, out: np.ndarray, bias: float, shifts: np.ndarray, constant: float | None = None):
        self.table, self.filters, self.out, self.bias, self.shifts, self.constant = table, filters, out, bias, shifts, constant

    def pooled(self, words: np.ndarray, heads: np.ndarray, bounds: np.ndarray):
        """The largest responses (texts x filters), and what the backward pass needs.

        Each text gets zero rows behind it, so that a filter never reaches the next text.
        """
        n, tail = len(bounds) - 1, max(WIDTHS)
        place = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(bounds)) * tail
        rows_w = np.full(len(words) + n * tail, _PAD, np.int32)
        rows_h = rows_w.copy()
        rows_w[place], rows_h[place] = words, heads
        x = self.table[rows_w] + self.table[rows_h]
        first = bounds[:-1] + np.arange(n) * tail
        ends = first + np.maximum(np.diff(bounds), 1)
        spans = np.stack([first, ends], 1).ravel()
        best, responses = [], {}
        for width in WIDTHS:
            weight, bias = self.filters[width]
            size = len(x) - width + 1
            r = np.zeros((len(x), FILTERS), np.float32)
            r[:size] = bias
            for j in range(width):
                r[:size] += x[j : j + size] @ weight[j * DIM : (j + 1) * DIM]
            responses[width] = r
            best.append(np.maximum.reduceat(r, spans, axis=0)[::2])
        return np.concatenate(best, 1), (x, rows_w, rows_h, first, ends, responses)

    def logits(self, words, heads, bounds) -> np.ndarray:
        return np.maximum(self.pooled(words, heads, bounds)[0], 0).astype(np.float64) @ self.out + self.bias

    def scores(self, words, heads, bounds, groups) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bounds) - 1, self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(words, heads, bounds) + self.shifts[groups], -30, 30)))


def _together(texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(a) for a, _ in texts])]).astype(np.int64)
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *(a for a, _ in texts)]), np.concatenate([none, *(b for _, b in texts)]), bounds


def train(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, groups: np.ndarray) -> Model:
    """Learn from texts (table rows of words and beginnings), labels 0 or 1, and language groups; deterministic."""
    rng = np.random.default_rng(7)
    shifts = np.zeros(len(FUNCTION_WORDS) + 1)
    filters = {w: [rng.normal(0, 0.1, (w * DIM, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32)] for w in WIDTHS}
    if not len(y) or y.min() == y.max():
        constant = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros((ROWS + 1, DIM), np.float32), filters, np.zeros(0), 0.0, shifts, constant)
    aside = np.zeros(len(y), bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        if len(own) >= 2 * ASIDE:
            aside[own[::ASIDE]] = True
    used = np.flatnonzero(~aside)

    table = rng.normal(0, 0.02, (ROWS + 1, DIM)).astype(np.float32)
    table[:, 0] = _evidence([texts[i] for i in used], y[used])
    table[_PAD] = 0
    for weight, _ in filters.values():
        weight[::DIM] += 0.5  # the first component carries the evidence to start with
    model = Model(table, filters, np.full(FILTERS * len(WIDTHS), 0.2), -1.0, shifts)
    sums = {"table": np.full(ROWS + 1, 1e-2, np.float32), "out": np.full(len(model.out), 1e-2), "bias": 1e-2}
    sums |= {w: [np.full_like(a, 1e-2) for a in filters[w]] for w in WIDTHS}
    weight_of = np.where(y == 1, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max((1 - y).sum(), 1)))
    order = np.zeros(0, np.int64)
    for _ in range(STEPS):
        while len(order) < BATCH:
            order = np.append(order, rng.permutation(used))
        chosen, order = order[:BATCH], order[BATCH:]
        _step(model, sums, [texts[i] for i in chosen], y[chosen], weight_of[chosen])

    check = np.flatnonzero(aside) if aside.any() else used
    found = np.concatenate([model.logits(*_together([texts[i] for i in check[a : a + 256]])) for a in range(0, len(check), 256)])
    whole = _cut(found, y[check])
    for group in range(len(shifts)):
        mine = groups[check] == group
        enough = min(y[check][mine].sum(), (1 - y[check][mine]).sum()) >= 10
        shifts[group] = np.log(THRESHOLD / (1 - THRESHOLD)) - (_cut(found[mine], y[check][mine]) if enough else whole)
    return model


def _evidence(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """How much more often a row occurs in texts labelled 1, as a shrunken log-ratio, to start from."""
    n = np.zeros((2, ROWS + 1))
    for (a, b), label in zip(texts, y):
        n[int(label)][np.unique(np.concatenate([a, b]))] += 1
    one, zero = (n[1] + 0.5) / (y.sum() + 1), (n[0] + 0.5) / ((1 - y).sum() + 1)
    seen = n.sum(0)
    return (np.clip(np.log(one / zero), -2, 5) * seen / (seen + 4)).astype(np.float32)


def _step(model: Model, sums: dict, texts: list, y: np.ndarray, weight: np.ndarray) -> None:
    """One AdaGrad step; only where a filter responded most does anything flow back."""
    pooled, (x, rows_w, rows_h, first, ends, responses) = model.pooled(*_together(texts))
    active = np.maximum(pooled, 0).astype(np.float64)
    error = weight * (1 / (1 + np.exp(-np.clip(active @ model.out + model.bias, -30, 30))) - y) / len(y)
    back = error[:, None] * model.out[None, :] * (pooled > 0)
    g = active.T @ error + 1e-4 * model.out
    sums["out"] += g * g
    model.out -= RATE * g / np.sqrt(sums["out"])
    g = error.sum()
    sums["bias"] += g * g
    model.bias -= RATE * g / np.sqrt(sums["bias"])
    rows, grads = [], []
    for k, width in enumerate(WIDTHS):
        w, b = model.filters[width]
        part = back[:, k * FILTERS : (k + 1) * FILTERS].astype(np.float32)
        top = np.stack([first[i] + responses[width][first[i] : ends[i]].argmax(0) for i in range(len(y))])
        windows = np.stack([x[top + j] for j in range(width)], 2).reshape(len(y), FILTERS, width * DIM)
        down = part[:, :, None] * w.T[None]
        for j in range(width):
            flat = down[:, :, j * DIM : (j + 1) * DIM].reshape(-1, DIM)
            rows += [rows_w[top + j].ravel(), rows_h[top + j].ravel()]
            grads += [flat, flat]
        for value, kept, g in ((w, sums[width][0], np.einsum("nf,nfd->df", part, windows)), (b, sums[width][1], part.sum(0))):
            kept += g * g
            value -= RATE * g / np.sqrt(kept)
    rows, grads = np.concatenate(rows), np.concatenate(grads)
    own, inverse = np.unique(rows, return_inverse=True)
    total = np.zeros((len(own), DIM), np.float32)
    np.add.at(total, inverse, grads)
    total[own == _PAD] = 0
    sums["table"][own] += (total * total).mean(1)
    model.table[own] -= RATE * total / np.sqrt(sums["table"][own])[:, None]


def _cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit with the best F1, in the middle of the gap around it."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.argmax(f1))
    after = logits[order[at + 1]] if at + 1 < len(y) else logits[order[at]] - 2
    return float((logits[order[at]] + after) / 2)
