"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swellmark import schemas


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # enforceSchema=False checks the header against the schema instead of going by position.
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, quote='"', escape='"')


def read_news_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.NEWS)


def read_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    """Weekly or hourly price table; dates without time mean midnight."""
    return _read_csv(spark, path, schemas.RATES)


def read_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table with the columns of `schema`, even when it is empty or lacks some.

    With `fmt`, any installed connector (a document store, say) is read with
    the schema enforced. Without it, `name` is a path if it has a slash and a
    catalog table otherwise.
    """
    if fmt is not None:
        reader = spark.read.format(fmt).schema(schema).options(**dict(options or {}))
        return reader.load(name) if name else reader.load()
    if "/" in name:
        return spark.read.schema(schema).parquet(name).select(*schema.fieldNames())
    table = spark.table(name)
    return table.select(
        *[
            (F.col(f.name) if f.name in table.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def jdbc_options(
    url: str, table: str, part_col: str | None, lo, hi, n: int, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Reader options; with `part_col` the scan is split into n ranges."""
    options = {"url": url, "dbtable": table, **dict(extra or {})}
    if part_col is not None:
        options.update(partitionColumn=part_col, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(n))
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    part_col: str | None = None,
    lo=None,
    hi=None,
    n: int = 1,
    **extra: str,
) -> DataFrame:
    """A database table, scanned in parallel ranges of `part_col`. Credentials come from the caller."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, part_col, lo, hi, n, extra)).load()


def read_gold(spark: SparkSession, name: str = "gold", order: bool = True, keep_route: bool = False) -> DataFrame:
    """The four gold columns, by time; with `keep_route` the route as well, for a table that was stored with it."""
    gold = read_table(spark, name, schemas.GOLD_BY_ROUTE if keep_route else schemas.GOLD)
    return gold.orderBy("full_date") if order else gold
