"""Quantiles of any window from stored sketches.

A sketch per day and key is made once, from that day's rows, and stored. A window of
days is answered by merging its sketches: the rows are not read again, and a day that
is restated replaces only its own sketches. Sketches are Spark's KLL sketches of doubles;
their size depends on `k` alone, not on the rows behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swellmark.functions.scalars import without_nan
from swellmark.sources.snapshots import SnapshotTable

#: Accuracy of a sketch: see `rank_error`.
K = 400

#: Number of the write that stated a day.
STATED = "stated"


def rank_error(k: int = K) -> float:
    """Part of all values by which the rank of an estimate is off at most, with 99 % confidence.

    The two numbers are the ones the sketch library states for sketches of single ranks.
    """
    return 2.296 / k**0.9021


def daily_sketches(
    df: DataFrame, c: str = "Price", keys: Sequence[str] = ("Route",), ts: str = "full_date", k: int = K
) -> DataFrame:
    """`day`, keys, `n`, `sketch`: one row per day and key that has values. Null and NaN are no values.

    Partial sketches are merged where they arise, so a hot day costs one sketch per task.
    """
    values = df.select(F.to_date(ts).alias("day"), *keys, without_nan(c).alias("_v")).where("_v is not null")
    return values.groupBy("day", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", k).alias("sketch")
    )


def _table(spark: SparkSession, path: str, keys: Sequence[str]) -> SnapshotTable:
    fields = [T.StructField("day", T.DateType()), *[T.StructField(k, T.StringType()) for k in keys]]
    fields += [T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField(STATED, T.LongType())]
    return SnapshotTable(spark, path, T.StructType(fields))


def write_sketches(sketches: DataFrame, path: str, keys: Sequence[str] = ("Route",)) -> int:
    """Store the sketches of whole days; returns their number. Days that are there already count as restated.

    Earlier statements stay in their files, which are in order of days, until the table is compacted.
    """
    table = _table(sketches.sparkSession, path, keys)
    stated = sketches.withColumn(STATED, F.lit(table.version() + 1).cast("long"))
    return table.append(stated.repartitionByRange("day").sortWithinPartitions("day"))


def read_sketches(spark: SparkSession, path: str, keys: Sequence[str] = ("Route",)) -> DataFrame:
    """The sketches of each day as last stated: a key that a restated day no longer has is gone."""
    stored = _table(spark, path, keys).read()
    # A row per day, which the calendar bounds.
    last = stored.groupBy("day").agg(F.max(STATED).alias(STATED))
    return stored.join(F.broadcast(last), ["day", STATED]).select("day", *keys, "n", "sketch")


def window_quantiles(
    sketches: DataFrame,
    probs: Sequence[float],
    keys: Sequence[str] = ("Route",),
    start: str | None = None,
    end: str | None = None,
    k: int = K,
) -> DataFrame:
    """keys, `n`, `q_0`, `q_1`, ... over the days from start to end, both included.

    Each estimate is one of the values; its rank is off by `rank_error(k)` times n at most,
    as a rule. Keys without a day in the window have no row.
    """
    kept = sketches
    if start is not None:
        kept = kept.where(F.col("day") >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.where(F.col("day") <= F.lit(end).cast("date"))
    merged = kept.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_s"))
    merged = merged.where("n is not null")
    return merged.select(
        *keys, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(f"q_{i}") for i, p in enumerate(probs)]
    )


def rank_errors(df: DataFrame, estimates: DataFrame, probs: Sequence[float], c: str, keys: Sequence[str]) -> DataFrame:
    """keys, `prob`, `n`, `off`: by what part of n an estimate's true rank misses its place.

    An estimate that stands for several equal values misses by the distance to the nearest of them.
    `estimates` has a row per key, so the join sends few rows out and counts many.
    """
    listed = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(f"q_{i}").alias("_q")) for i, p in enumerate(probs)])
    wanted = estimates.select(*keys, F.inline(listed))
    values = df.select(*keys, without_nan(c).alias("_v")).where("_v is not null")
    counted = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")).join(wanted, list(keys))
    ranks = counted.groupBy(*keys, "prob").agg(
        F.sum("_n").alias("n"),
        F.sum(F.when(F.col("_v") < F.col("_q"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_v") <= F.col("_q"), F.col("_n")).otherwise(0)).alias("_upto"),
    )
    place = F.col("prob") * F.col("n")
    miss = F.greatest(F.col("_below") - place, place - F.col("_upto"), F.lit(0.0))
    return ranks.select(*keys, "prob", "n", (miss / F.col("n")).alias("off"))
