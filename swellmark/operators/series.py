"""Day-grain time series: lag scan, running risk, volatility.

All windows here run over day rows. `to_daily` reduces the hourly table with
map-side partial sums first, so a key has at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from swellmark.functions.moments import safe_corr
from swellmark.operators.ordering import neighbours


def _by(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*(keys or [F.lit(0)]))


def to_daily(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day (and key): mean and closing price, the day's news and risk."""
    return (
        gold.groupBy(*keys, F.to_date("full_date").alias("day"))
        .agg(
            F.avg("Price").alias("avg_price"),
            F.max_by("Price", "full_date").alias("close_price"),
            F.max("news_count").alias("news_count"),
            F.max("avg_conflict_score").alias("avg_conflict_score"),
        )
        .withColumn("Risk_Score", F.col("news_count") * F.col("avg_conflict_score"))
    )


def lag_scan(
    daily: DataFrame,
    max_lag: int = 30,
    keys: Sequence[str] = (),
    price: str = "avg_price",
    risk: str = "Risk_Score",
) -> DataFrame:
    """Correlation of risk on day d with price on day d + lag, for lag = 0..max_lag.

    Days pair by date, never by row offset, so missing days cannot shift the
    series. A range window hands each price day the risks of the last max_lag
    days; pairs are formed after that shuffle and summed up where they arise.
    Output: keys, lag, n, r, rank (1 = highest r).
    """
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    recent = _by(keys).orderBy("_d").rangeBetween(-max_lag, 0)
    pairs = (
        daily.select(*keys, number.alias("_d"), F.col(price).alias("_p"), F.col(risk).alias("_r"))
        .select(*keys, "_d", "_p", F.collect_list(F.struct("_d", "_r")).over(recent).alias("_past"))
        .select(*keys, F.col("_d").alias("_to"), "_p", F.inline("_past"))
        .select(*keys, (F.col("_to") - F.col("_d")).alias("lag"), "_p", "_r")
    )
    scan = pairs.groupBy(*keys, "lag").agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_r").isNotNull()).alias("n"),
        safe_corr("_r", "_p").alias("r"),
    )
    best = _by(keys).orderBy(F.desc_nulls_last("r"), "lag")
    return scan.select(*keys, "lag", "n", "r", F.row_number().over(best).alias("rank"))


def cumulative_risk(daily: DataFrame, keys: Sequence[str] = (), risk: str = "Risk_Score") -> DataFrame:
    """Running total of daily risk over time."""
    so_far = _by(keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(*keys, "day", F.col(risk), F.sum(risk).over(so_far).alias("cumulative_risk"))


def daily_returns(
    daily: DataFrame, keys: Sequence[str] = (), price: str = "close_price", spread: bool = False
) -> DataFrame:
    """Relative change of the closing price since the last day that has one.

    With `spread` a key's rows need not fit a task: its range partitions hand each other their last rows.
    """
    if spread:
        met = neighbours(daily, keys, ["day"], [price])
        change = F.try_divide(F.col(price), F.col("before")[price]) - 1
        return met.select(*keys, "day", F.col(price), change.alias("daily_return"))
    before = F.lag(price).over(_by(keys).orderBy("day"))
    return daily.select(
        *keys, "day", F.col(price), (F.try_divide(F.col(price), before) - 1).alias("daily_return")
    )


def volatility(
    daily: DataFrame,
    window: int = 7,
    keys: Sequence[str] = (),
    price: str = "close_price",
) -> DataFrame:
    """Daily returns and their standard deviation over the last `window` rows."""
    last = _by(keys).orderBy("day").rowsBetween(-(window - 1), 0)
    return daily_returns(daily, keys, price).withColumn(
        "rolling_sd", F.stddev_samp("daily_return").over(last)
    )


def volatility_clustering(
    daily: DataFrame, keys: Sequence[str] = (), price: str = "close_price"
) -> DataFrame:
    """Lag-1 autocorrelation of squared returns: above 0, calm and rough days cluster."""
    squared = daily_returns(daily, keys, price).withColumn("_sq", F.col("daily_return") * F.col("daily_return"))
    paired = squared.withColumn("_before", F.lag("_sq").over(_by(keys).orderBy("day")))
    return paired.groupBy(*keys).agg(
        F.count_if(F.col("_before").isNotNull()).alias("n"),
        safe_corr("_sq", "_before").alias("autocorrelation"),
    )
