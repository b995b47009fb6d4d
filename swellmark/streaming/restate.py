"""Days that are restated when articles come late.

A watermarked aggregate drops rows behind the watermark without a word. Here every batch
leaves partial sums per day, and a day is the total of its parts: a late article changes
its day. What came behind the watermark is also counted and stored aside, and the days as
they stood without it can still be had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from swellmark.functions.scalars import conflict_intensity
from swellmark.sources.commits import CommitLog
from swellmark.sources.snapshots import SnapshotTable
from swellmark.streaming.daily import require_utc

PARTS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("is_late", T.BooleanType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_scores", T.LongType()),
        T.StructField("scores", T.DoubleType()),
    ]
)


def _parts(base: str, spark: SparkSession) -> SnapshotTable:
    return SnapshotTable(spark, f"{base}/parts", PARTS)


def late_table(spark: SparkSession, base: str, schema: T.StructType) -> SnapshotTable:
    """Articles that came behind the watermark; `schema` is the stream's."""
    return SnapshotTable(spark, f"{base}/late", schema)


def add_articles(rows: DataFrame, base: str, batch: str, delay: str = "2 days", ts: str = "ts") -> tuple[int, int]:
    """Add one batch (ts, Tone, ...); returns its numbers of partial sums and of late articles.

    The watermark is the latest time of all batches before, less `delay`; an article of an
    earlier time is late. It is kept with the batch, so a batch that runs again judges alike.
    Articles without a time are left out.
    """
    spark = rows.sparkSession
    require_utc(spark)
    marks = CommitLog(spark, f"{base}/marks")
    # One entry per batch: the mark it was judged by and the mark it leaves behind.
    entry = marks.find("batch", batch)
    if entry is None:
        last = marks.latest()
        before = last["after"] if last else None
        latest = rows.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()[0]
        after = max([t for t in (before, latest) if t is not None], default=None)
        numbers = marks.numbers()
        entry = {"batch": batch, "before": before, "after": after}
        marks.commit(numbers[-1] + 1 if numbers else 1, entry)
    late = F.lit(False)
    if entry["before"] is not None:
        mark = F.timestamp_micros(F.lit(entry["before"])) - F.expr(f"interval {delay}")
        late = F.col(ts).cast("timestamp") < mark
    judged = rows.where(F.col(ts).isNotNull()).withColumn("is_late", late)
    score = conflict_intensity("Tone")
    sums = judged.groupBy(F.to_date(ts).alias("event_date"), "is_late").agg(
        F.count(F.lit(1)).alias("n"), F.count(score).alias("n_scores"), F.sum(score).alias("scores")
    )
    late_rows = late_table(spark, base, rows.schema).append(judged.where("is_late").drop("is_late"), batch)
    return _parts(base, spark).append(sums, batch), late_rows


def restated_days(spark: SparkSession, base: str, with_late: bool = True) -> DataFrame:
    """`event_date`, `news_count`, `avg_conflict_score`, `late_count`; without late articles, as first stated.

    A row per day that has articles; sums of a few numbers per day and batch.
    """
    parts = _parts(base, spark).read()
    kept = parts if with_late else parts.where("not is_late")
    days = kept.groupBy("event_date").agg(
        F.sum("n").alias("news_count"),
        F.try_divide(F.sum("scores"), F.sum("n_scores")).alias("avg_conflict_score"),
        F.sum(F.when(F.col("is_late"), F.col("n")).otherwise(0)).alias("late_count"),
    )
    return days


def stream_restated(
    stream: DataFrame, base: str, checkpoint: str, delay: str = "2 days", ts: str = "ts", trigger: dict | None = None
) -> StreamingQuery:
    """Add each batch of a stream of articles; read the days with `restated_days`."""

    def store(rows: DataFrame, number: int) -> None:
        add_articles(rows, base, f"stream-{number}", delay, ts)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
