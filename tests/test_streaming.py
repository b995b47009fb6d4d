from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from swellmark.operators.gold import aggregate_news
from swellmark.operators.upsample import upsample_linear
from swellmark.streaming.daily import stream_daily, stream_daily_dedup, stream_dedup, stream_gold

SCHEMA = "ts timestamp_ntz, Tone double, SourceURL string"
T0 = datetime(2024, 1, 1)


@pytest.fixture
def articles(spark, tmp_path):
    """Ten days of articles every two hours, in one file per day."""
    rows = [(T0 + timedelta(hours=2 * i), -float(i % 5), f"u{i}") for i in range(120)]
    for day in range(10):
        part = [r for r in rows if r[0].date() == (T0 + timedelta(days=day)).date()]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def source(spark, path, per_batch=1000):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(path)


def drain(stream, out):
    stream.writeStream.outputMode("append").format("parquet").option("path", f"{out}/data").option(
        "checkpointLocation", f"{out}/check"
    ).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{out}/data")


def batch_days(spark, path):
    news = spark.read.parquet(path).withColumn("Day", F.date_format("ts", "yyyyMMdd"))
    return {r.event_date: (r.news_count, r.avg_conflict_score) for r in aggregate_news(news).collect()}


@pytest.mark.parametrize("per_batch", [1000, 2])
def test_closed_days_equal_the_batch_result(spark, articles, tmp_path, per_batch):
    got = drain(stream_daily(source(spark, articles, per_batch)), str(tmp_path / "out")).collect()
    want = batch_days(spark, articles)
    # The last article is of day 10, 22:00; two days before that, days 1 to 7 are over.
    assert len(got) == 7
    for row in got:
        assert (row.news_count, row.avg_conflict_score) == want[row.event_date]


def test_repeats_are_dropped_before_counting(spark, articles, tmp_path):
    twice = source(spark, articles).union(source(spark, articles))
    got = drain(stream_daily_dedup(twice), str(tmp_path / "out")).collect()
    want = batch_days(spark, articles)
    assert len(got) == 7 and all(r.news_count == want[r.event_date][0] for r in got)


def test_dedup_over_batches_and_keys(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(3):
        rows = [(T0 + timedelta(hours=i), -1.0, "hot")] * 50 + [(T0 + timedelta(hours=i), -1.0, f"u{i}")]
        spark.createDataFrame(rows, SCHEMA).repartition(4).write.mode("append").parquet(path)
    got = drain(stream_dedup(source(spark, path, 4), ["SourceURL"]), str(tmp_path / "out"))
    assert sorted(r.SourceURL for r in got.collect()) == ["hot", "u0", "u1", "u2"]


def test_gold_is_stored_by_day_and_can_be_rerun(spark, articles, tmp_path):
    weekly = spark.createDataFrame(
        [(T0, "r", 100.0), (T0 + timedelta(days=14), "r", 436.0)], "Date timestamp_ntz, Route string, Price double"
    )
    out = str(tmp_path / "gold")
    for run in ("one", "two"):
        stream_gold(source(spark, articles, 3), upsample_linear(weekly), out, str(tmp_path / run)).awaitTermination()
        gold = spark.read.parquet(out)
        assert gold.count() == 7 * 24
        assert gold.where("full_date = timestamp_ntz'2024-01-03 12:00:00'").first().Price == 160.0
    assert gold.select("event_date").distinct().count() == 7
    assert gold.select("full_date").distinct().count() == 7 * 24
