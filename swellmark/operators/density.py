"""Kernel density by a fast Gauss transform.

The direct sum costs values x grid points. Here values are gathered into boxes one
bandwidth wide, and a box stands for its values by a few moments about its centre. A
grid point adds up the Hermite expansions of the boxes near it. Moments are plain sums,
so values are read once and combined where they are; what is left are boxes x points
near them, however many values there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swellmark.functions.scalars import without_nan
from swellmark.operators.stats import _facts, _grid

#: A box is one bandwidth w wide, so its values lie within HALF of its centre in units of sqrt(2) w.
HALF = 0.5 / math.sqrt(2.0)

#: Bound of Hermite functions in Cramer's inequality.
CRAMER = 1.0865


def terms_for(error: float) -> int:
    """Terms of the expansion that leave out less than `error` for a value in its box.

    By Cramer's inequality what is left out after p terms is at most the sum over k >= p
    of CRAMER * (sqrt(2) * HALF)^k / sqrt(k!), where sqrt(2) * HALF is a half.
    """
    p = 1
    while 2 * CRAMER * 0.5**p / math.sqrt(math.factorial(p)) > error:
        p += 1
    return p


def reach_for(error: float) -> float:
    """Distance of a grid point from a centre, in units of sqrt(2) w, from which a value adds less than `error`."""
    return HALF + math.sqrt(math.log(1.0 / error))


def fast_density(
    df: DataFrame,
    c: str = "Risk_Score",
    points: int = 200,
    bins: int | None = None,
    error: float = 1e-10,
) -> DataFrame:
    """`density`, within `error` times the height of the kernel: x, density.

    Scott's bandwidth, an even grid from min to max; with `bins` scaled to counts per
    histogram bin, the error then being `error` times n times the height of a scaled kernel.
    Null where all values are equal, no rows without a value.
    """
    if not 0 < error < 1:
        raise ValueError(f"error is a part of the kernel's height, not {error}")
    terms, reach = terms_for(error / 2), reach_for(error / 2)
    values = df.select(without_nan(c).alias("_v")).where("_v is not null")
    width = F.nullif("sd", F.lit(0.0)) * F.pow("n", F.lit(-0.2))
    area = F.lit(1.0) if bins is None else F.col("n") * (F.col("hi") - F.col("lo")) / F.lit(bins)
    ends = values.agg(
        F.min("_v").alias("lo"),
        F.max("_v").alias("hi"),
        F.count("_v").cast("double").alias("n"),
        F.stddev_samp("_v").alias("sd"),
    )
    facts = _facts(
        ends,
        lo=F.col("lo"),
        width=width,
        step=(F.col("hi") - F.col("lo")) / F.lit(max(points - 1, 1)),
        scale=F.try_divide(area, F.col("n") * width * F.lit(math.sqrt(2.0 * math.pi))),
    )
    boxes = _moments(values, facts, terms)
    sums = _evaluated(boxes, facts, points, reach).groupBy("i").agg(F.sum("_k").alias("_sum"))
    grid = ends.where("n > 0").select(
        F.inline(_grid(points)), F.try_divide(area, F.col("n") * width * F.lit(math.sqrt(2.0 * math.pi))).alias("_scale")
    )
    # At most `points` rows on both sides. Equal points, of a range without length, are one.
    curve = grid.join(sums, "i", "left").groupBy("x").agg(F.max("_sum").alias("_sum"), F.max("_scale").alias("_scale"))
    return curve.select("x", (F.coalesce("_sum", F.lit(0.0)) * F.col("_scale")).alias("density"))


def _moments(values: DataFrame, facts: Column, terms: int) -> DataFrame:
    """`_box`, `_moments`: sums of s^k / k! over the values of a box, s being their place about its centre."""
    placed = values.select("_v", F.lit(facts).alias("_f")).where("_f.width is not null")
    placed = placed.select(((F.col("_v") - F.col("_f.lo")) / F.col("_f.width")).alias("_at"))
    placed = placed.select(F.floor("_at").alias("_box"), "_at")
    placed = placed.select("_box", ((F.col("_at") - F.col("_box") - 0.5) * F.lit(1 / math.sqrt(2.0))).alias("_s1"))
    for k in range(2, terms):
        placed = placed.withColumn(f"_s{k}", F.col(f"_s{k - 1}") * F.col("_s1"))
    sums = [F.count(F.lit(1)).cast("double").alias("_m0")]
    sums += [(F.sum(f"_s{k}") / F.lit(float(math.factorial(k)))).alias(f"_m{k}") for k in range(1, terms)]
    return placed.groupBy("_box").agg(*sums).select("_box", F.array(*[f"_m{k}" for k in range(terms)]).alias("_moments"))


def _evaluated(boxes: DataFrame, facts: Column, points: int, reach: float) -> DataFrame:
    """`i`, `_k`: what each box adds at each grid point within reach."""
    near = boxes.select("_box", "_moments", F.lit(facts).alias("_f"))
    near = near.withColumn("_centre", (F.col("_box") + 0.5) * F.col("_f.width"))
    away = F.lit(reach * math.sqrt(2.0)) * F.col("_f.width")
    first = F.greatest(F.ceil((F.col("_centre") - away) / F.col("_f.step")), F.lit(0))
    last = F.least(F.floor((F.col("_centre") + away) / F.col("_f.step")), F.lit(points - 1))
    spread = near.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    spread = spread.select("*", F.explode(F.sequence("_first", "_last")).alias("i"))
    t = (F.col("i") * F.col("_f.step") - F.col("_centre")) / (F.lit(math.sqrt(2.0)) * F.col("_f.width"))
    spread = spread.select("i", "_moments", t.alias("_t"))
    start = F.struct(
        F.lit(0.0).alias("before"), F.exp(-F.col("_t") * F.col("_t")).alias("now"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k")
    )

    def add(state: Column, moment: Column) -> Column:
        """The next Hermite function from the two before it."""
        after = F.col("_t") * 2 * state["now"] - state["k"] * 2 * state["before"]
        return F.struct(
            state["now"].alias("before"),
            after.alias("now"),
            (state["sum"] + moment * state["now"]).alias("sum"),
            (state["k"] + 1).alias("k"),
        )

    return spread.select("i", F.aggregate("_moments", start, add, lambda state: state["sum"]).alias("_k"))
