"""Raw exports as a stream: each file is read once, its rows cleaned, numbered and stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from swellmark import fixed, schemas
from swellmark.operators.cleaning import clean_news
from swellmark.operators.ordering import dense_ids
from swellmark.sources.commits import IdLedger
from swellmark.sources.exports import RAW, export_lines, parsed_exports
from swellmark.sources.snapshots import SnapshotTable

REJECTS = T.StructType([*RAW.fields, T.StructField("reject_reason", T.StringType())])
FILES = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("is_data", T.BooleanType()),
        T.StructField("batch", T.StringType()),
    ]
)


class ExportStore:
    """What ingestion keeps below `base`: news with ids that carry on, rejects, files done."""

    def __init__(self, spark: SparkSession, base: str, start: int = fixed.FIRST_EVENT_ID):
        self.news = SnapshotTable(spark, f"{base}/news", schemas.NEWS)
        self.rejects = SnapshotTable(spark, f"{base}/rejects", REJECTS)
        self.files = SnapshotTable(spark, f"{base}/files", FILES)
        self.ids = IdLedger(spark, f"{base}/ids", start)

    def add(self, lines: DataFrame, batch: str, strict_sniff: bool = False, **cleaning) -> int:
        """Store one batch of lines (`value`, `file_path`, `opening`); returns the number of news.

        Each step is keyed by the batch, so one that failed half-way can be run again: what is stored stays, ids are the same.
        """
        read = export_lines(lines)
        news, rejects = clean_news(parsed_exports(read, strict_sniff), keep_rejects=True, **cleaning)
        # Places in the sorted batch first; the block of ids is asked for when their number is known.
        placed = dense_ids(news, "Day", ["SourceURL", "Tone"], start=0, name="_place")
        first = self.ids.grant(batch, placed.count())
        numbered = placed.withColumn("GlobalEventID", F.col("_place") + F.lit(first))
        self.rejects.append(rejects, batch)
        dated = F.arrays_overlap("names", F.array(*[F.lit(a) for a in fixed.DATE_ALIASES]))
        done = read.groupBy("file_path").agg(
            F.count_if(~F.col("is_header")).alias("n_lines"),
            F.max(F.col("marked") if strict_sniff else dated).alias("is_data"),
            F.lit(batch).alias("batch"),
        )
        self.files.append(done, batch)
        return self.news.append(numbered.select(*schemas.NEWS.fieldNames()), batch)


def export_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of files as they arrive in a folder; each file is read once, whole, in one batch."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(folder).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        (F.col("_metadata.file_block_start") == 0).alias("opening"),
    )


def stream_exports(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    start: int = fixed.FIRST_EVENT_ID,
    on_batch: Callable[[str, int], None] | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Store each batch of an `export_stream` in the `ExportStore` of `base`.

    A batch that runs again after a failure changes nothing that it has stored before.
    `on_batch` hears the batch's name and its number of news.
    """

    def store(lines: DataFrame, number: int) -> None:
        batch = f"stream-{number}"
        rows = ExportStore(lines.sparkSession, base, start).add(lines, batch, **options)
        if on_batch is not None:
            on_batch(batch, rows)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
