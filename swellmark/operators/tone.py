"""Tone of a text from two word lists."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}]+"


def with_lexicon_tone(
    docs: DataFrame,
    positive: Collection[str],
    negative: Collection[str],
    text: str = "text",
    name: str = "Tone",
) -> DataFrame:
    """Add 100 x (positive - negative) / words; null for a text without words.

    The words of a text stay in its row, so a long or often copied text causes
    no shuffle. The word lists are arguments, hence small.
    """
    good, bad = sorted(positive), sorted(negative)
    words = F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")

    def tone(found: Column) -> Column:
        balance = F.size(F.filter(found, lambda w: w.isin(good))) - F.size(F.filter(found, lambda w: w.isin(bad)))
        return F.try_divide(F.lit(100.0) * balance, F.size(found))

    # An array of one names the words: a filter on the tone, pushed to the scan, would cut a text anew for each use of them.
    return docs.withColumn(name, F.get(F.transform(F.array(words), tone), F.lit(0)))


def lexicon_tone(
    docs: DataFrame,
    positive: Collection[str],
    negative: Collection[str],
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """The tone of each document."""
    return with_lexicon_tone(docs.select(key, text), positive, negative, text).select(key, "Tone")
