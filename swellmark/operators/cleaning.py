"""Raw export rows to the typed news table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swellmark import fixed
from swellmark.functions.scalars import day_key, first_non_empty, hash_normal, parse_day, parse_tone, stripped

NEWS_COLUMNS = ("Day", "Country", "Tone", "SourceURL")


def clean_header(name: str) -> str:
    """A column name without byte-order mark, blanks and surrounding quotes."""
    return name.lstrip("\ufeff").strip().strip('"').strip()


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def _alias_value(df: DataFrame, aliases: Sequence[str]) -> Column:
    """Aliases match exactly, in the order given; a repeated header means its last column."""
    return first_non_empty([df[f"`{a}`"] for a in aliases if a in df.columns])


def with_aliases(df: DataFrame) -> DataFrame:
    """Reduce a raw export to its three raw text columns, whatever their spelling."""
    return df.select(
        _alias_value(df, fixed.DATE_ALIASES).alias("raw_date"),
        _alias_value(df, fixed.URL_ALIASES).alias("raw_url"),
        _alias_value(df, fixed.TONE_ALIASES).alias("raw_tone"),
    )


def union_exports(frames: Sequence[DataFrame]) -> DataFrame:
    """Append batches by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tone(policy: str, seed: int) -> Column:
    tone = parse_tone("raw_tone")
    if policy in ("null", "drop"):
        return tone
    if policy == "hash_normal":
        keys = ["raw_date", "raw_url", "raw_tone"]
        return F.coalesce(
            tone, hash_normal(keys, fixed.TONE_FALLBACK_MEAN, fixed.TONE_FALLBACK_SD, seed)
        )
    raise ValueError(f"tone_policy must be 'null', 'drop' or 'hash_normal', not {policy!r}")


def clean_news(
    raw: DataFrame,
    country: str = fixed.COUNTRY,
    keep_rejects: bool = False,
    tone_policy: str = "null",
    seed: int = 0,
):
    """Typed news rows from raw text rows; ids are assigned later by `dense_ids`.

    `raw` has raw_date, raw_url, raw_tone (see `with_aliases`), or export
    columns under any known spelling. With `keep_rejects` the result is the
    pair (news, rejects), where rejects carry a `reject_reason`.
    """
    if "raw_date" not in raw.columns:
        raw = with_aliases(normalize_headers(raw))
    url = stripped("raw_url")
    judged = raw.select(
        *raw.columns,
        day_key("raw_date").alias("day"),
        url.alias("url"),
        _tone(tone_policy, seed).alias("tone"),
    ).withColumn(
        "reject_reason",
        F.when(F.col("day").isNull(), "date")
        .when(F.coalesce(F.length("url"), F.lit(0)) == 0, "url")
        .when(F.lit(tone_policy == "drop") & F.col("tone").isNull(), "tone"),
    )
    news = judged.where(F.col("reject_reason").isNull()).select(
        F.col("day").cast("string").alias("Day"),
        F.lit(country).alias("Country"),
        F.col("tone").alias("Tone"),
        F.col("url").alias("SourceURL"),
    )
    if not keep_rejects:
        return news
    rejects = judged.where(F.col("reject_reason").isNotNull()).select(*raw.columns, "reject_reason")
    return news, rejects


def undated(news: DataFrame) -> DataFrame:
    """How many rows passed ingestion but will find no calendar date at the join."""
    return news.agg(
        F.count("*").alias("rows"),
        F.count_if(parse_day("Day").isNull()).alias("undated_rows"),
    )


def phrase_pattern(phrases: Sequence[str]) -> str:
    """One alternation over all phrases, for lower-case text.

    Word borders are spelled out, because what counts as a word sign for a
    border in patterns depends on the Java version. Other signs, as in
    bab-el-mandeb, stand for themselves.
    """
    border = r"[^\p{L}\p{N}]"
    return f"(^|{border})(" + "|".join(re.sub(r"([^\w\s])", r"\\\1", p.lower()) for p in phrases) + f")({border}|$)"


def match_news(
    df: DataFrame,
    text_col: str,
    phrases: Sequence[str],
    max_tone: float | None = fixed.MAX_TONE,
    tone_col: str = "Tone",
) -> DataFrame:
    """Rows whose text holds any of the words or exact phrases, with tone below the bound.

    Case does not matter and matches start and end at word borders.
    """
    kept = df.where(F.lower(text_col).rlike(phrase_pattern(phrases)))
    return kept if max_tone is None else kept.where(F.col(tone_col) < max_tone)


def month_number(day: Column) -> Column:
    """yyyyMM as a number: the partition column of the stored news table."""
    return F.year(day) * 100 + F.month(day)


def study_window(
    df: DataFrame,
    start: str = fixed.STUDY_START,
    end: str = fixed.STUDY_END,
    day: str = "event_date",
    month: str = "event_month",
) -> DataFrame:
    """Days from start to end, both included; prunes month partitions where there are any."""
    lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    kept = df.where(F.col(day).between(lo, hi))
    if month in df.columns:
        kept = kept.where(F.col(month).between(int(start[:4]) * 100 + int(start[5:7]), int(end[:4]) * 100 + int(end[5:7])))
    return kept
