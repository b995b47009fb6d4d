"""The batch job: exports and weekly prices in, gold table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swellmark import fixed, schemas
from swellmark.operators.cleaning import clean_news, study_window
from swellmark.operators.gold import build_gold
from swellmark.operators.ordering import cap_per_group, dense_ids
from swellmark.operators.upsample import upsample_rates
from swellmark.session import sized_shuffles
from swellmark.sources.exports import read_raw_exports
from swellmark.sources.sinks import write_if_nonempty, write_news, write_rates
from swellmark.sources.tables import read_rates_csv, read_table


def news_from_exports(
    spark: SparkSession,
    exports: str | Sequence[str],
    per_day: int | None = None,
    strict_sniff: bool = False,
    **cleaning,
) -> DataFrame:
    """Saved exports to the news table: clean, number; with `per_day`, only the first so many of each day."""
    raw = read_raw_exports(spark, exports, strict_sniff)
    # Cleaning is lazy, but numbering runs in here: its sort ends in a checkpoint.
    with sized_shuffles(raw):
        news = clean_news(raw, **cleaning)
        if per_day is not None:
            news = cap_per_group(news, "Day", [F.col("SourceURL"), F.col("Tone")], per_day)
        return dense_ids(news, "Day", ["SourceURL", "Tone"]).select(*schemas.NEWS.fieldNames())


def refresh(
    spark: SparkSession,
    exports: str | Sequence[str],
    weekly_csv: str,
    base: str,
    noise_sd: float = fixed.NOISE_SD,
    seed: int = 0,
    route: str | None = None,
    keep_route: bool = False,
    **news_options,
) -> dict[str, int]:
    """Rebuild news, rates and gold below `base`; returns the row count of each.

    Steps read what the step before has stored. A step that fails raises and
    leaves the table it was to replace untouched.
    """
    counts = {"news": write_news(news_from_exports(spark, exports, **news_options), f"{base}/news")}
    hourly = upsample_rates(read_rates_csv(spark, weekly_csv), route, noise_sd, seed)
    counts["rates"] = write_rates(hourly, f"{base}/rates")
    rates = read_table(spark, f"{base}/rates", schemas.RATES)
    news = read_table(spark, f"{base}/news", schemas.STORED_NEWS)
    first, last = rates.agg(F.to_date(F.min("Date")), F.to_date(F.max("Date"))).first()
    if first is not None:
        # The join would drop other days anyway; said beforehand, whole months are not read.
        news = study_window(news, first.isoformat(), last.isoformat())
    gold = build_gold(rates, news, keep_route)
    counts["gold"] = write_if_nonempty(gold, f"{base}/gold")
    return counts
