"""Writers. A path target is replaced only after the new data is completely written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from swellmark.functions.scalars import parse_day
from swellmark.operators.cleaning import month_number


def run_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass. Read `observation.get['rows']` after the action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _file_system(df: DataFrame, path: str):
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"could not rename {old} to {new}")


def _swap(df: DataFrame, staged: str, target: str) -> None:
    """Put the staged folder in the target's place; the old one goes last."""
    fs, path = _file_system(df, target)
    old = path(f"{target}.old-{uuid.uuid4().hex}")
    if fs.exists(path(target)):
        _rename(fs, path(target), old)
    try:
        _rename(fs, path(staged), path(target))
    except Exception:
        if fs.exists(old):
            _rename(fs, old, path(target))
        raise
    if fs.exists(old):
        fs.delete(old, True)


def _staged_write(df: DataFrame, target: str, save: Callable[[DataFrame, str], None], skip_empty: bool = False) -> int:
    """Write next to the target, count on the way, swap; returns the row count."""
    counted, seen = run_metrics(df, f"write-{uuid.uuid4().hex}")
    staged = f"{target}.staged-{uuid.uuid4().hex}"
    try:
        save(counted, staged)
    except Exception:
        fs, path = _file_system(df, staged)
        fs.delete(path(staged), True)
        raise
    rows = seen.get["rows"]
    if skip_empty and rows == 0:
        fs, path = _file_system(df, staged)
        fs.delete(path(staged), True)
    else:
        _swap(df, staged, target)
    return rows


def _parquet(*partition_by: str) -> Callable[[DataFrame, str], None]:
    return lambda df, path: df.write.partitionBy(*partition_by).parquet(path)


def _csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, quote='"', escape='"')


def write_news(df: DataFrame, target: str) -> int:
    """Replace the news table, partitioned by month; returns the row count.

    One shuffle by month and a slice of each month keeps the number of files
    per partition small, also when one month holds a third of the rows.
    """
    day = parse_day("Day")
    dated = df.withColumn("event_date", day).withColumn("event_month", month_number(day))
    return _staged_write(dated.hint("rebalance", "event_month"), target, _parquet("event_month"))


def write_rates(df: DataFrame, target: str) -> int:
    """Replace the hourly price table; returns the row count."""
    return _staged_write(df.select("Date", "Route", "Price"), target, _parquet())


def write_if_nonempty(df: DataFrame, target: str) -> int:
    """Replace the target, unless `df` is empty: then the old data stays. Returns the row count.

    The plan runs once: rows are counted while they are staged.
    """
    return _staged_write(df, target, _parquet(), skip_empty=True)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    column_types: str | None = None,
    batchsize: int = 10_000,
    **extra: str,
) -> None:
    """Replace a database table in batched inserts; `column_types` as in a DDL."""
    df.write.format("jdbc").mode("overwrite").options(
        **jdbc_write_options(url, table, column_types, batchsize, extra)
    ).save()


def jdbc_write_options(url: str, table: str, column_types: str | None, batchsize: int, extra: dict) -> dict:
    options = {"url": url, "dbtable": table, "batchsize": str(batchsize), **extra}
    if column_types is not None:
        options["createTableColumnTypes"] = column_types
    return options


def write_csv(df: DataFrame, path: str) -> int:
    """CSV with header line; returns the row count."""
    return _staged_write(df, path, _csv)
