"""Bounds and counts of stored tables from file footers, without reading rows.

Parquet files keep the least and greatest value and the number of values per column.
Spark answers aggregates from them when the table is read through its second data source
interface with aggregate pushdown; both are settings of a session, so a session of its own
is used and the caller's stays as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose bounds Spark takes from footers. Timestamps are not among them: store a date.
KINDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session like `spark`, with the same catalogue and cluster, in which aggregates reach the footers."""
    other = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        other.conf.set(name, spark.conf.get(name))
    others = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s and s != "parquet"]
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_bounds(
    spark: SparkSession, path: str, cols: Sequence[str], schema: T.StructType | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """`min_c` and `max_c` for each column and `n` rows, from footers; per folder value with partition columns `by`.

    A table without a file gives one row of nulls, n as well (none with `by`). Raises for columns
    whose type has no bounds in footers, instead of reading all rows unnoticed.
    """
    reader = footer_session(spark).read
    table = (reader.schema(schema) if schema is not None else reader).parquet(path)
    wrong = [c for c in cols if not isinstance(table.schema[c].dataType, KINDS)]
    if wrong:
        raise TypeError(f"footers hold no bounds that Spark uses for {', '.join(wrong)}")
    counted = F.count(F.lit(1)).alias("n")
    parts = [part for c in cols for part in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return table.groupBy(*by).agg(*parts, counted) if by else table.agg(*parts, counted)


def reads_footers_only(df: DataFrame) -> bool:
    """Whether the plan takes its aggregates from footers."""
    plan = df._jdf.queryExecution().toString()
    return "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan
