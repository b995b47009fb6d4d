"""Stored intermediate tables and the connected components of stored links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swellmark.session import scratch_path

#: Rows of an Arrow batch while a table is written.
BATCH = 2000

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, label: str, batch: int = BATCH) -> DataFrame:
    """Write `df` as Parquet below spark.checkpoint.dir and read it back.

    Later steps see fixed rows with known sizes, and a lost executor costs a
    re-read instead of the work before. Python workers get at most `batch` rows at
    once meanwhile, since rows here may hold whole texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(int(before), batch) if int(before) > 0 else batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """`node`, `component`: the smallest node reachable over `links` (columns a, b: long).

    Alternating large and small stars: each round hangs every node's larger
    neighbours, then its smaller ones, on the smallest node around. Only minima
    are gathered per node, never a node's neighbours. Nodes without a link don't
    appear. A node's links may be many; the join on them is one that adaptive
    execution can split.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        edges = stored(small.where("a <> b").distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = edges.groupBy("b").agg(F.first("b").alias("component")).select(F.col("b").alias("node"), "component")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)


def _state(edges: DataFrame) -> tuple[int, int, int]:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mixed, 32))
    ).first()
    return row[0], row[1] or 0, row[2] or 0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
