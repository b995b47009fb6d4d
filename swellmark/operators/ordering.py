"""Order-dependent operators that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swellmark import fixed
from swellmark.session import cut

#: monotonically_increasing_id: partition number above, row position below this bit.
POSITION_BITS = 33

#: Sub-groups per group for the first of the two cuts in `cap_per_group`.
CAP_SALTS = 64


def _range_sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally sorted, written out, with its partition number and row position.

    Range partitions follow the data, so a hot key is spread over several of
    them. The checkpoint fixes the sampled boundaries and the row order, hence
    partition and position mean the same thing to every later job.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    mark = F.monotonically_increasing_id()
    return placed.select(
        "*",
        F.shiftrightunsigned(mark, POSITION_BITS).alias("_part"),
        mark.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_pos"),
    )


def dense_ids(
    df: DataFrame,
    day: str,
    order: Sequence[str],
    start: int = fixed.FIRST_EVENT_ID,
    unique_by: str | None = None,
    name: str = "GlobalEventID",
) -> DataFrame:
    """Gap-free running ids by (day, order), without a global window.

    Rows equal in all order columns need a tie-breaker to be split over tasks.
    `unique_by` names one; without it the input is written out once and the
    row's place in that copy is used.
    """
    if unique_by is None:
        df = cut(df).withColumn("_tie", F.monotonically_increasing_id())
        tie = "_tie"
    else:
        tie = unique_by
    rows = _range_sorted(df, [day, *order, tie])
    # One row per partition: bounded by the partition count, whatever the data.
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start) + F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before", "_tie")
    )


def prefix_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    name: str,
    total: str | None = None,
    slice_name: str | None = None,
) -> DataFrame:
    """Running total of `amount` per key in the given order, over groups of any size.

    (keys, order) must identify a row. Totals run inside each range partition
    and are shifted by the sum of the partitions before it. On request `total`
    adds the key's grand total, and `slice_name` keeps the partition number:
    (slice, keys) are evenly sized groups, to join on instead of hot keys.
    """
    rows = _range_sorted(df, [*keys, *order])
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sizes = rows.groupBy("_part", *keys).agg(F.sum(amount).alias("_n"))
    # At most one row per partition and key.
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        *keys,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )
    running = rows.withColumn(name, F.sum(amount).over(inside)).join(offsets, ["_part", *keys])
    return running.select(
        *df.columns,
        (F.col(name) + F.col("_before")).alias(name),
        *([F.col("_total").alias(total)] if total else []),
        *([F.col("_part").alias(slice_name)] if slice_name else []),
    )


def cap_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence,
    n: int,
) -> DataFrame:
    """The first n rows of each group by `order`.

    Cut twice: the first n of every sub-group contain the first n of the group,
    so the second cut sees at most CAP_SALTS * n rows per group. Sub-groups follow
    the input partition: that spreads even equal rows, and a retried task has the
    same partition number.
    """
    groups = [group] if isinstance(group, str) else list(group)
    salted = df.withColumn("_salt", F.spark_partition_id() % CAP_SALTS)
    coarse = Window.partitionBy(*groups, "_salt").orderBy(*order)
    fine = Window.partitionBy(*groups).orderBy(*order)
    return (
        salted.withColumn("_rank", F.row_number().over(coarse))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(fine))
        .where(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    before: str = "before",
    after: str = "after",
    carried: Mapping[str, str] | None = None,
) -> DataFrame:
    """Each row with its neighbours in its key: `before` and `after` are structs of `cols`, null at the ends.

    `carried` names columns to add: the last value that is not null, up to and including
    the row, of the column given for each. (keys, order) must identify a row; a null key is a key.

    One key may hold all rows: neighbours are looked up inside range partitions, and the
    partitions exchange their outermost rows, one of each per partition and key.
    """
    carried = dict(carried or {})
    rows = _range_sorted(df, [*keys, *order]).withColumn("_own", F.struct(*cols))
    inside = Window.partitionBy("_part", *keys).orderBy("_pos")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select(
        *rows.columns,
        F.lag("_own").over(inside).alias("_left"),
        F.lead("_own").over(inside).alias("_right"),
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"_held_{i}") for i, c in enumerate(carried.values())],
    )
    edges = rows.groupBy("_part", *keys).agg(
        F.min_by("_own", "_pos").alias("_first"),
        F.max_by("_own", "_pos").alias("_last"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_tail_{i}") for i, c in enumerate(carried.values())],
    )
    # At most one row per partition and key.
    line = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    met = edges.select(
        F.col("_part").alias("_at"),
        *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)],
        F.lag("_last").over(line).alias("_from"),
        F.lead("_first").over(line).alias("_to"),
        *[F.last(f"_tail_{i}", ignorenulls=True).over(earlier).alias(f"_past_{i}") for i in range(len(carried))],
    )
    same = placed["_part"] == met["_at"]
    for i, k in enumerate(keys):
        same = same & placed[k].eqNullSafe(met[f"_of_{i}"])
    return placed.join(met, same).select(
        *[placed[c] for c in df.columns],
        F.coalesce("_left", "_from").alias(before),
        F.coalesce("_right", "_to").alias(after),
        *[F.coalesce(f"_held_{i}", f"_past_{i}").alias(name) for i, name in enumerate(carried)],
    )
