"""The daily aggregate on a stream of articles (ts, Tone, SourceURL, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swellmark.functions.scalars import conflict_intensity
from swellmark.operators.gold import join_daily

#: Sub-keys for the first of the two passes in `stream_dedup`.
DEDUP_SALTS = 16


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "+00:00"):
        raise ValueError(f"days of a stream are days of UTC; the session's time zone is {zone}")


def _watermarked(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    # Watermarks need a TIMESTAMP; in a UTC session the cast keeps the wall clock.
    require_utc(stream.sparkSession)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _per_day(marked: DataFrame, ts: str) -> DataFrame:
    return (
        marked.groupBy(F.window(ts, "1 day").alias("w"))
        .agg(
            F.count("*").alias("news_count"),
            F.avg(conflict_intensity("Tone")).alias("avg_conflict_score"),
        )
        .select(F.to_date("w.start").alias("event_date"), "news_count", "avg_conflict_score")
    )


def stream_daily(stream: DataFrame, delay: str = "2 days", ts: str = "ts") -> DataFrame:
    """News per day; in append mode a day comes out once the watermark has passed its end."""
    return _per_day(_watermarked(stream, ts, delay), ts)


def stream_dedup(
    stream: DataFrame, key: str | list[str] = "SourceURL", delay: str = "2 days", ts: str = "ts"
) -> DataFrame:
    """Drop repeats of an article within the watermark. The result carries the watermark.

    Two passes: first within sub-keys by input partition, then over the rest,
    so that copies of one hot article do not all meet in one task.
    """
    keys = [key] if isinstance(key, str) else key
    marked = _watermarked(stream, ts, delay).withColumn("_salt", F.spark_partition_id() % DEDUP_SALTS)
    return marked.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(keys)


def stream_daily_dedup(
    stream: DataFrame, key: str | list[str] = "SourceURL", delay: str = "2 days", ts: str = "ts"
) -> DataFrame:
    """`stream_daily` over articles without repeats."""
    return _per_day(stream_dedup(stream, key, delay, ts), ts)


def stream_gold(
    stream: DataFrame,
    rates: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "2 days",
    keep_route: bool = False,
    ts: str = "ts",
    **trigger,
) -> StreamingQuery:
    """Join each closed day to its hourly prices and store it as a partition of gold.

    Writing a day replaces that day's partition only, so a batch that is run
    again after a failure leaves the same table.
    """

    def store(batch: DataFrame, _epoch: int) -> None:
        # A few closed days: one row with their range lets the price scan skip all other days.
        days = batch.persist()
        try:
            lo, hi = days.agg(F.min("event_date"), F.max("event_date")).first()
            if lo is None:
                return
            prices = rates.where(F.to_date("Date").between(F.lit(lo), F.lit(hi)))
            gold = join_daily(prices, days, keep_route).withColumn("event_date", F.to_date("full_date"))
            gold.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
        finally:
            days.unpersist()

    return (
        stream_daily(stream, delay, ts)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
