"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import textbits

#: Lengths of n-grams, hashed features, and what is added to each count.
LENGTHS, FEATURES, SMOOTHING = (1, 2, 3), 1 << 16, 0.5

UNKNOWN = "und"

#: Text bytes handled at once: a few hundred bytes of numbers each.
BLOCK = 1 << 18

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Whether a row may be learned from: crc32 of its id as text, modulo 4, is not 2. A null id is not."""
    return F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 4 != 2, F.lit(False))


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in the order of code points, and per feature their log-probabilities; row FEATURES holds log priors.

    `rows` has `text` and `lang`; rows without a language are left out. Counts
    cover all rows: each task sums its own per language and feature, so what is
    gathered is bounded by languages times features.
    """
    counted = rows.where("lang is not null").select("lang", "text").mapInArrow(
        _count, "lang string, feature int, n double"
    )
    found = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique(), key=lambda x: x.encode())
    at = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((FEATURES + 1, len(langs)))
    counts[found["feature"].to_numpy(np.int64), found["lang"].map(at).to_numpy(np.int64)] = found["n"]
    grams, texts = counts[:-1] + SMOOTHING, counts[-1]
    model = np.empty_like(counts)
    model[:-1] = np.log(grams) - np.log(grams.sum(0))
    if langs:
        model[:-1] -= model[:-1].mean(1, keepdims=True)  # a feature's mean tells no language from another
    model[-1] = np.log(np.maximum(texts, 0.5)) - np.log(max(texts.sum(), 1.0))
    return langs, model


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score` for every row of `docs`.

    Learns from the texts and languages of `training_rows`; predicts from texts
    alone. score is the posterior probability of lang_pred. A text that is null,
    empty or without a letter is `und` with score 0, and so is every text when
    there is nothing to learn from. Ties go to the first language by code points.
    Null ids are kept, not held out and not learned from. Repeated rows come back
    as often as they came in. No rows give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    model = learn(rows.where(training_rows(rows)).select("text", "lang"))
    held = F.coalesce(~training_rows(rows), F.lit(False)) & F.col("doc_id").isNotNull()
    rows = rows.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text")
    return rows.mapInArrow(_predict(docs, model), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, columns as they are, with a language: not `und`, and a score of `least` or more."""
    model = learn(docs.where(training_rows(docs)).select("text", "lang"))
    kept = _keep(docs, model, least)
    return docs.mapInArrow(kept, docs.schema)


def _keep(docs: DataFrame, model, least: float):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _scores(batch.column("text"), *shared.value)
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(langs, scores)], pa.bool_()))

    return keep


def _predict(docs: DataFrame, model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _scores(batch.column("text"), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """By code point: the lower-case letter, or a space for what is no letter."""
    global _LETTERS
    if _LETTERS is None:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            sign = chr(c)
            if sign.isalpha():
                low = sign.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS = table
    return _LETTERS


def _signs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts as `_letters` has them, a space behind each text; and where each text starts (n + 1)."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = heads[offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    signs = np.insert(_letters()[points], starts[1:], 32)
    return signs, starts + np.arange(len(starts))


def _features(signs: np.ndarray, length: int) -> np.ndarray:
    """The hashed feature of the n-gram at each sign, as far as there is one."""
    n = max(0, len(signs) - length + 1)
    h = np.full(n, length, np.uint32) * _MULTIPLIERS[3]
    for j in range(length):
        h = (h ^ signs[j : j + n]) * _MULTIPLIERS[j]
        h ^= h >> np.uint32(15)
    return (h * _MULTIPLIERS[0]) >> np.uint32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lo, hi, data, offsets in textbits.blocks(batch.column("text"), BLOCK):
            signs, starts = _signs(data, offsets)
            names, own = np.unique(langs[lo:hi].astype(str), return_inverse=True)
            of = np.repeat(own, np.diff(starts))
            for name in names:
                totals.setdefault(name, np.zeros(FEATURES + 1))[FEATURES] += np.count_nonzero(langs[lo:hi] == name)
            for length in LENGTHS:
                found = _features(signs, length)
                whole = _inside(starts, length, len(found))
                for i, name in enumerate(names):
                    mine = whole & (of[: len(found)] == i)
                    totals[name][:FEATURES] += np.bincount(found[mine], minlength=FEATURES)
    for name, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
            ["lang", "feature", "n"],
        )


def _inside(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which n-grams lie in one text."""
    whole = np.ones(n, bool)
    for j in range(1, length):
        at = starts[1:] - j
        whole[at[(at >= 0) & (at < n)]] = False
    return whole


def _scores(column: pa.Array, langs: list[str], model: np.ndarray) -> tuple[list[str], list[float]]:
    out_langs, out_scores = [], []
    for lo, hi, data, offsets in textbits.blocks(column, BLOCK):
        signs, starts = _signs(data, offsets)
        lettered = np.add.reduceat(signs != 32, starts[:-1]) > 0
        totals = np.tile(model[-1], (hi - lo, 1))
        for length in LENGTHS if langs else ():
            found = _features(signs, length)
            values = model[found]
            values[~_inside(starts, length, len(found))] = 0
            values = np.concatenate([values, np.zeros((len(signs) - len(values), len(langs)))])
            totals += np.add.reduceat(values, starts[:-1], axis=0)
        for i in range(hi - lo):
            if not langs or not lettered[i]:
                out_langs.append(UNKNOWN), out_scores.append(0.0)
                continue
            best = int(np.argmax(totals[i]))
            out_langs.append(langs[best])
            out_scores.append(float(1 / np.exp(totals[i] - totals[i][best]).sum()))
    return out_langs, out_scores
