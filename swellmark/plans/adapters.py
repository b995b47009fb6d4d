"""Projections of the given tables onto news and price tables.

The tables at hand hold no news and no freight rates, so dated amounts stand in
for them. The factor pi keeps means and products off rounding ties, where two
engines may round differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swellmark.operators.frames import risk_score
from swellmark.operators.gold import build_gold, week_start
from swellmark.operators.upsample import upsample_linear
from swellmark.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _day_text(ts: str):
    return F.date_format(ts, "yyyyMMdd")


# --- a month of events: every event an article and, with its value, a price ---


def short_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") + 100000).alias("GlobalEventID"),
        _day_text("ts").alias("Day"),
        F.lit("YEM").alias("Country"),
        (-F.col("value") / F.pi()).alias("Tone"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("SourceURL"),
    )


def short_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(
        table(spark, sf_dir, "events").withColumn("Route", F.lit("all")),
        "ts", "Route", "value",
    )


def short_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsample_linear(short_weekly(spark, sf_dir))


def short_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(short_hourly(spark, sf_dir), short_news(spark, sf_dir))


def short_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_score(short_gold(spark, sf_dir), half_even=False)


# --- years of orders: every line is an article, one price series per priority ---


def long_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("GlobalEventID"),
        _day_text("l_shipdate").alias("Day"),
        F.lit("YEM").alias("Country"),
        (-F.col("l_quantity") / F.pi()).alias("Tone"),
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("SourceURL"),
    )


def long_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority", "o_totalprice")


def long_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsample_linear(long_weekly(spark, sf_dir))


def long_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(long_hourly(spark, sf_dir), long_news(spark, sf_dir), keep_route=True)


def long_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_score(long_gold(spark, sf_dir), half_even=False)


def _weekly(df: DataFrame, ts: str, route: str, price: str) -> DataFrame:
    return (
        df.groupBy(week_start(F.to_date(ts)).cast("timestamp_ntz").alias("Date"), F.col(route).alias("Route"))
        .agg(F.avg(F.col(price) * F.pi()).alias("Price"))
        .select("Date", "Route", "Price")
    )
