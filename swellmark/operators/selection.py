"""Quantiles by radix selection: counting instead of sorting.

A double becomes a 64-bit number with the same order. Passes look at 16 bits each:
values that share the bits found so far are counted by their next 16, and the counts
say in which of the 65,536 cells a wanted rank lies. After the fourth pass the cell is
the value; as soon as no wanted cell holds more values than a pass has cells, one pass
over all bits left finishes. No pass sorts or gathers values: what is shuffled are
counts, at most 65,536 per group, rank and task, and a hot value is one number.

The passes read two columns of the input, which are written out first; with `rescan`
they read the input itself, which suits a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swellmark.functions.scalars import without_nan
from swellmark.session import written

#: Bits per pass, and of a double.
DIGIT, WIDTH = 16, 64

#: Rows of a small table that is handed to all tasks; a larger one is joined by a shuffle.
SMALL = 20_000

#: Layout of a double: bits of its fraction, bias of its exponent.
FRACTION, BIAS = 52, 1023

_UNIT = float(2**FRACTION)
_SMALLEST = 1 - BIAS
_LOWEST = -(2**63)
_INFINITE = (2 * BIAS + 1) << FRACTION


def with_order_key(df: DataFrame, c: str, name: str = "_key") -> DataFrame:
    """Add a long that orders as the double `c` does; equal for 0.0 and -0.0, null for null and NaN.

    Exponent and fraction are taken apart by exact steps: powers of two, and products with
    them. Each step is a column of its own, which keeps Spark from computing it again where it is used.
    """
    size, guess, power = F.col("_size"), F.col("_guess"), F.col("_power")
    steps = df.withColumn("_clean", without_nan(c)).withColumn("_size", F.abs("_clean"))
    # The logarithm may be off by one next to a power of two.
    inside = F.least(F.greatest(F.log2("_size"), F.lit(float(_SMALLEST))), F.lit(float(BIAS)))
    steps = steps.withColumn("_guess", F.floor(inside).cast("int"))
    steps = steps.withColumn("_power", F.pow(F.lit(2.0), guess))
    off = F.when((guess < BIAS) & (size >= power * 2), 1).when((guess > _SMALLEST) & (size < power), -1).otherwise(0)
    steps = steps.withColumn("_off", off)
    scale = F.when(F.col("_off") == 1, power * 2).when(F.col("_off") == -1, power / 2).otherwise(power)
    fraction = (size / scale * _UNIT).cast("long")
    normal = F.shiftleft((guess + F.col("_off") + (BIAS - 1)).cast("long"), FRACTION) + fraction
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == F.lit(float("inf")), F.lit(_INFINITE))
        .when(size < F.lit(2.0**_SMALLEST), (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise(normal)
    )
    steps = steps.withColumn("_bits", bits)
    signed = steps.withColumn(name, F.when(F.col("_clean") < 0, -F.col("_bits")).otherwise(F.col("_bits")))
    return signed.select(*df.columns, name)


def key_value(key: Column) -> Column:
    """The double of a key that `with_order_key` gave."""
    bits = F.abs(key)
    exponent = F.shiftright(bits, FRACTION).cast("int")
    fraction = bits.bitwiseAND(F.lit(2**FRACTION - 1)).cast("double")
    size = (
        F.when(exponent == 2 * BIAS + 1, F.lit(float("inf")))
        .when(exponent == 0, fraction * F.lit(2.0**-537) * F.lit(2.0**-537))
        .otherwise((fraction / _UNIT + 1) * F.pow(F.lit(2.0), exponent - BIAS))
    )
    return F.when(key < 0, -size).otherwise(size)


def _bits(key: Column, at: int, n: int) -> Column:
    """The n bits of a key behind its first `at`, the key being shifted so as to be never negative."""
    raised = F.shiftrightunsigned(key.bitwiseXOR(F.lit(_LOWEST)), WIDTH - at - n)
    return raised if at == 0 else raised.bitwiseAND(F.lit(2**n - 1))


def _keyed(df: DataFrame, keys: Sequence[str], c: str, rescan: bool) -> DataFrame:
    values = df.select(*keys, without_nan(c).alias("_v")).where("_v is not null")
    values = with_order_key(values, "_v")
    return values if rescan else written(values, "values")


def _settled(found: DataFrame) -> tuple[DataFrame, bool, int]:
    """The computed cells, whether they are few as expected, and the size of the largest."""
    held = found.limit(SMALL + 1).toArrow()
    if len(held) > SMALL:
        stored = written(found, "cells")
        return stored, False, stored.agg(F.max("_n")).first()[0]
    return found.sparkSession.createDataFrame(held, found.schema), True, max(held["_n"].to_pylist(), default=0)


def _meet(values: DataFrame, table: DataFrame, fits: bool, on: Column) -> DataFrame:
    return values.join(F.broadcast(table) if fits else table, on)


def _wanted(probs: Sequence[float]) -> Column:
    """Ranks from 0 on that the quantiles need: the two neighbours of each place."""
    places = [F.lit(float(p)) * (F.col("_size") - 1) for p in probs]
    ranks = [r for p in places for r in (F.floor(p), F.ceil(p))]
    return F.array(*[F.struct(F.lit(i).alias("t"), r.cast("long").alias("rank")) for i, r in enumerate(ranks)])


def _narrowed(cells: DataFrame, group: Sequence) -> DataFrame:
    """Cells that hold wanted ranks, with those ranks counted from the cell's first value."""
    line = Window.partitionBy(*group).orderBy("_rest").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_before", F.coalesce(F.sum("_n").over(line), F.lit(0)))
    inside = F.filter(
        "_ranks", lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n"))
    )
    moved = F.transform(
        "_ranks", lambda r: F.struct(r["t"].alias("t"), (r["rank"] - F.col("_before")).alias("rank"))
    )
    return placed.withColumn("_ranks", inside).where(F.size("_ranks") > 0).withColumn("_ranks", moved)


def radix_quantiles(
    df: DataFrame, keys: Sequence[str], c: str, probs: Sequence[float], rescan: bool = False
) -> DataFrame:
    """Linearly interpolated quantiles per group: keys, n, q_0, q_1, ...; exact, without sorting.

    Null and NaN are no values; a group without a value has no row. Infinite values
    count; a quantile between two different values of which one is infinite is infinite,
    and one between both infinities null. Null keys are a group.
    """
    return _quantiles(_keyed(df, list(keys), c, rescan), list(keys), probs)[0]


def _quantiles(values: DataFrame, keys: list[str], probs: Sequence[float]) -> tuple[DataFrame, bool]:
    # The first pass: all values of a group, by their top digit.
    first = _bits(F.col("_key"), 0, DIGIT)
    cells = values.groupBy(*keys, first.alias("_rest")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    cells = cells.withColumn("_size", F.sum("_n").over(whole)).withColumn("_ranks", _wanted(probs))
    found = _narrowed(cells, keys or [F.lit(0)]).select(*keys, "_size", F.col("_rest").alias("_found"), "_ranks", "_n")
    small, known = _settled(found), DIGIT
    while known < WIDTH:
        # At most two rows per group and quantile.
        step = WIDTH - known if small[2] <= 2**DIGIT else DIGIT
        table = small[0].select(
            *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)], "_size", "_found", "_ranks"
        )
        same = reduce(
            lambda x, y: x & y,
            [values[k].eqNullSafe(table[f"_of_{i}"]) for i, k in enumerate(keys)],
            # Null-safe: else a filter on the key, with all its steps written out, goes down into the scan.
            _bits(values["_key"], 0, known).eqNullSafe(table["_found"]),
        )
        held = _meet(values, table, small[1], same).withColumn("_rest", _bits(F.col("_key"), known, step))
        cells = held.groupBy(*keys, "_size", "_found", "_ranks", "_rest").agg(F.count(F.lit(1)).alias("_n"))
        found = _narrowed(cells, [*keys, "_found"])
        found = found.select(
            *keys, "_size", F.shiftleft("_found", step).bitwiseOR(F.col("_rest")).alias("_found"), "_ranks", "_n"
        )
        small, known = _settled(found), known + step
    value = key_value(F.col("_found").bitwiseXOR(F.lit(_LOWEST)))
    one = small[0].select(*keys, "_size", value.alias("_v"), F.inline("_ranks")).groupBy(*keys, "_size")
    picked = one.agg(*[F.max(F.when(F.col("t") == i, F.col("_v"))).alias(f"_v{i}") for i in range(2 * len(probs))])
    out = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("_size") - 1)
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        between = low + (high - low) * (place - F.floor(place))
        out.append(without_nan(F.when(low == high, low).otherwise(between)).alias(f"q_{i}"))
    return picked.select(*keys, F.col("_size").alias("n"), *out), small[1]


def radix_box_stats(
    df: DataFrame, group: str = "Period", c: str = "Price", reach: float = 1.5, rescan: bool = False
) -> DataFrame:
    """Box-plot figures per group as `box_stats` gives them, from selected quartiles.

    The boxes, a row per group, meet the values once more for whiskers and outliers.
    """
    values = _keyed(df.where(F.col(group).isNotNull()), [group], c, rescan)
    boxes, fits = _quantiles(values, [group], [0.25, 0.5, 0.75])
    boxes = boxes.toDF("_group", "n", "q1", "median", "q3")
    span = (F.col("q3") - F.col("q1")) * F.lit(reach)
    held = _meet(values, boxes, fits, values[group] == boxes["_group"])
    inside = F.col("_v").between(F.col("q1") - span, F.col("q3") + span)
    return (
        held.groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("_min"),
            F.max(F.when(inside, F.col("_v"))).alias("_max"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            group, "n", "q1", "median", "q3",
            F.least("_min", "q1").alias("whisker_lo"),
            F.greatest("_max", "q3").alias("whisker_hi"),
            "outliers",
        )
    )
