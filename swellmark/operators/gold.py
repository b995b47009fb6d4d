"""News per day, joined onto hourly prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swellmark.functions.scalars import conflict_intensity, day_text, parse_day


def week_start(day: Column) -> Column:
    """The Monday of the week, by date arithmetic (date_trunc would need a time zone)."""
    return F.date_sub(day, F.weekday(day))


def _by_day_text(news: DataFrame) -> DataFrame:
    """Sums per day text: dates are then parsed once per day, not once per article."""
    return (
        news.select(day_text("Day").alias("day_text"), conflict_intensity("Tone").alias("intensity"))
        .groupBy("day_text")
        .agg(F.count("*").alias("n"), F.count("intensity").alias("n_scored"), F.sum("intensity").alias("total"))
    )


def aggregate_news(news: DataFrame, grain: str = "day") -> DataFrame:
    """Article count and mean intensity per day (or per week, dated by its Monday).

    Articles without a tone count, but do not enter the mean. Rows whose Day is
    no date end up in one group with a null date.
    """
    if grain not in ("day", "week"):
        raise ValueError(f"grain must be 'day' or 'week', not {grain!r}")
    day = parse_day("day_text")
    return (
        _by_day_text(news)
        .groupBy((day if grain == "day" else week_start(day)).alias("event_date"))
        .agg(
            F.sum("n").alias("news_count"),
            F.try_divide(F.sum("total"), F.sum("n_scored")).alias("avg_conflict_score"),
        )
    )


def dated_news(news: DataFrame) -> DataFrame:
    """`aggregate_news` by day without the null group, one shuffle cheaper.

    A date has exactly one text of eight digits, so what is left after parsing
    is one row per day already.
    """
    return (
        _by_day_text(news)
        .select(
            # True for every group; mentioning the count keeps the optimizer from pushing the
            # test for null, and with it the parsing, below the aggregation.
            F.when(F.col("n") > 0, parse_day("day_text")).alias("event_date"),
            F.col("n").alias("news_count"),
            F.try_divide("total", "n_scored").alias("avg_conflict_score"),
        )
        .where(F.col("event_date").isNotNull())
    )


def join_daily(rates: DataFrame, daily: DataFrame, keep_route: bool = False) -> DataFrame:
    """Hourly prices with their day's news; hours of days without news are left out.

    `daily` holds one row per calendar day. Days come from eight digits, so
    there are at most 3,652,425 of them (years 0 to 9999, some 100 MB) however
    many articles were read: the broadcast is bounded by the calendar.
    """
    return rates.join(F.broadcast(daily), F.to_date("Date") == F.col("event_date"), "inner").select(
        F.col("Date").alias("full_date"),
        "Price",
        "news_count",
        "avg_conflict_score",
        *(["Route"] if keep_route else []),
    )


def build_gold(rates: DataFrame, news: DataFrame, keep_route: bool = False) -> DataFrame:
    """Hourly rates and article-level news to the gold table."""
    return join_daily(rates, dated_news(news), keep_route)
