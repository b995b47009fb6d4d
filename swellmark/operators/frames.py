"""The analysis frame, its window filters and its sorted views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swellmark import fixed
from swellmark.functions.scalars import rounded


def risk_score(
    gold: DataFrame,
    round_score: bool = True,
    digits: int = 2,
    half_even: bool = True,
) -> DataFrame:
    """Add Risk_Score = volume x intensity from the unrounded inputs, then round.

    `round_score=False` leaves avg_conflict_score as it is, as the notebook view does.
    """
    shown = gold.withColumn(
        "Risk_Score", rounded(F.col("news_count") * F.col("avg_conflict_score"), digits, half_even)
    ).withColumn("Price", rounded("Price", digits, half_even))
    if round_score:
        shown = shown.withColumn("avg_conflict_score", rounded("avg_conflict_score", digits, half_even))
    return shown


def with_period(
    df: DataFrame,
    cutoff_year: int = fixed.CUTOFF_YEAR,
    labels: tuple[str, str] = fixed.PERIOD_LABELS,
    ts: str = "full_date",
) -> DataFrame:
    """Label each row by whether its year reaches the cutoff."""
    late, early = labels
    return df.withColumn("Period", F.when(F.year(ts) >= cutoff_year, late).otherwise(early))


def filter_dates(df: DataFrame, start, end, ts: str = "full_date") -> DataFrame:
    """Calendar dates from start to end; the end day counts in full."""
    return df.where(F.to_date(ts).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_instants(df: DataFrame, start, end, ts: str = "full_date") -> DataFrame:
    """Instants from start to end; an end given as a date means its midnight."""
    return df.where(
        F.col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    )


def bounds(df: DataFrame, ts: str = "full_date") -> DataFrame:
    """First and last timestamp, one row."""
    return df.agg(F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))


def default_bounds(
    df: DataFrame,
    start: str = fixed.WINDOW_START,
    end: str = fixed.WINDOW_END,
    ts: str = "full_date",
) -> DataFrame:
    """The default window clamped to the dates the data has, one row: what a date picker shows."""
    return df.agg(
        F.greatest(F.lit(start).cast("date"), F.to_date(F.min(ts))).alias("start_date"),
        F.least(F.lit(end).cast("date"), F.to_date(F.max(ts))).alias("end_date"),
    )


def default_window(
    df: DataFrame,
    start: str = fixed.WINDOW_START,
    end: str = fixed.WINDOW_END,
    ts: str = "full_date",
) -> DataFrame:
    """The rows of the default window.

    No row lies outside the data's own dates, so clamping the window to them
    (see `default_bounds`) selects the same rows. Without it, no pass for the
    bounds is needed and the dates are pushed into the scan.
    """
    return filter_dates(df, start, end, ts)


def trend(df: DataFrame) -> DataFrame:
    """Risk bars and price line over time."""
    return df.select("full_date", "Risk_Score", "Price").orderBy("full_date")


def panic_meter(df: DataFrame) -> DataFrame:
    """Severity over time, with volume as size and price as colour."""
    return df.select("full_date", "avg_conflict_score", "news_count", "Price").orderBy("full_date")


def risk_line(df: DataFrame) -> DataFrame:
    return df.select("full_date", "Risk_Score").orderBy("full_date")


def raw_table(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest rows first. With a limit Spark keeps only the top rows per task."""
    newest = df.orderBy(F.desc("full_date"))
    return newest if limit is None else newest.limit(limit)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows by time."""
    return df.orderBy("full_date").limit(n)
