"""Token counts through a cache of digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.encoders import encoder, version
from llm.tables import stored

#: Contents whose counts a task remembers.
KNOWN = 100_000

CACHE = "version string, digest binary, n_tokens long"


def count_tokens(
    docs: DataFrame,
    cache: str,
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens`, `over_limit` for every row of `docs`.

    `cache` is a folder that all executors reach; it holds counts by tokenizer
    version (digest of its file) and content digest, and may be absent at first.
    Contents are normalised to their UTF-8 bytes, a null to the empty text: any
    further change could alter a count. Contents the cache does not hold are
    encoded once each, however often they occur, and appended to it.

    Null and empty texts have 0 bytes and 0 tokens. Null ids are kept. Repeated
    rows come back as often as they came in. No rows give no rows. Other columns
    are ignored. Rows that two runs append for one content count once.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = stored(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    now = version(tokenizer)
    known = _cached(spark, cache).where(F.col("version") == now).select("digest")
    misses = keys.groupBy("digest").agg(F.min("doc_id").alias("head")).join(known, "digest", "left_anti")
    misses = stored(misses.withColumnRenamed("digest", "miss"), "misses")
    # On digest and id together: a content of many copies does not gather in one task.
    texts = rows.join(misses, (rows["digest"] == misses["miss"]) & rows["doc_id"].eqNullSafe(misses["head"]))
    fresh = texts.select("digest", "text").mapInArrow(_count(tokenizer), "digest binary, n_tokens long")
    fresh = fresh.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    fresh.select(F.lit(now).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = _cached(spark, cache).where(F.col("version") == now)
    counts = counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    return keys.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _cached(spark: SparkSession, cache: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _count(tokenizer: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        known: dict[bytes, int] = {}
        for batch in batches:
            # Rows alike in id and content all come here: one of them is encoded.
            if len(known) > KNOWN:
                known.clear()
            digests = batch.column("digest").to_pylist()
            for digest, text in zip(digests, batch.column("text")):
                if digest not in known:
                    known[digest] = len(own.ids(text.as_py()))
            each = dict.fromkeys(digests)
            counts = pa.array([known[d] for d in each], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(each, pa.binary()), counts], ["digest", "n_tokens"])

    return count
