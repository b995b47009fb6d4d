"""Statistics over the analysis frame.

Each operator is one or a few aggregations whose partial results are small.
Scalars such as bounds or bandwidth come in as scalar subqueries, not as joins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swellmark import fixed
from swellmark.functions.moments import paired, safe_corr
from swellmark.functions.scalars import hash_uniform, text_uniform, without_nan
from swellmark.operators.ordering import prefix_sum

#: Poisson(1) cumulative probabilities; the weight is how many of them a uniform exceeds.
POISSON_STEPS = [
    sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1)) for k in range(13)
]


def kpis(
    df: DataFrame,
    formatted: bool = False,
    placeholder: str = "N/A",
) -> DataFrame:
    """Peak price, total events (hour grain) and price-risk correlation in one row.

    An empty window gives a row of nulls, or of placeholders when formatted.
    """
    row = df.agg(
        F.max("Price").alias("peak_price"),
        F.sum("news_count").alias("total_events"),
        safe_corr("Price", "Risk_Score").alias("correlation"),
    )
    if not formatted:
        return row
    missing = F.lit(placeholder)
    return row.select(
        F.coalesce(F.concat(F.lit("$"), F.format_number("peak_price", 0)), missing).alias("peak_price"),
        F.coalesce(F.format_number("total_events", 0), missing).alias("total_events"),
        F.coalesce(F.format_number("correlation", 2), missing).alias("correlation"),
    )


def total_events(df: DataFrame, distinct_days: bool = False) -> DataFrame:
    """Sum of news_count over gold rows, or over days.

    Gold repeats a day's count on each of its hours (and routes); with
    `distinct_days` each day counts once.
    """
    if distinct_days:
        df = df.groupBy(F.to_date("full_date").alias("day")).agg(F.max("news_count").alias("news_count"))
    return df.agg(F.sum("news_count").alias("total_events"))


def corr_matrix(
    df: DataFrame,
    cols: Sequence[str] = ("Price", "news_count", "avg_conflict_score", "Risk_Score"),
) -> DataFrame:
    """All pairwise Pearson coefficients in long form (x, y, r), from one aggregation.

    The diagonal is 1, or null for a constant column.
    """
    pairs = list(combinations(cols, 2))
    row = df.agg(
        *[safe_corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)],
        *[F.when(F.stddev_pop(without_nan(c)) > 0, 1.0).alias(f"own_{i}") for i, c in enumerate(cols)],
    )
    cells = [_cell(c, c, F.col(f"own_{i}")) for i, c in enumerate(cols)]
    for i, (a, b) in enumerate(pairs):
        cells += [_cell(a, b, F.col(f"r_{i}")), _cell(b, a, F.col(f"r_{i}"))]
    return row.select(F.inline(F.array(*cells)))


def _cell(x: str, y: str, r: Column) -> Column:
    return F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), r.alias("r"))


def ols(df: DataFrame, x: str = "Risk_Score", y: str = "Price") -> DataFrame:
    """Least-squares line y ~ x over complete pairs; nulls where x is constant."""
    a, b = paired(x, y)
    return df.agg(
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        F.regr_r2(b, a).alias("r2"),
        F.regr_count(b, a).alias("n"),
    )


def ols_band(
    df: DataFrame,
    x: str = "Risk_Score",
    y: str = "Price",
    replicates: int = 1000,
    level: float = 0.95,
    seed: int = 0,
    keys: Sequence[str] | None = None,
    points: int = 100,
    blocks: int = 65_536,
    portable: bool = False,
) -> DataFrame:
    """Bootstrap confidence band of the fitted line on an even grid: (x, lo, hi).

    Rows are hashed by `keys` (default: all columns) into blocks, which are
    reduced to five sums each; a block's weight in a replicate is a Poisson(1)
    draw. Few rows get a block each, which is the plain row bootstrap; many rows
    share blocks at random, which estimates the same spread. So the draws are
    bounded by blocks x replicates however long the table is. With `portable` blocks
    and draws come from MD5 instead of Spark's own hash: slower, but other engines can draw the same.
    """
    a, b = paired(x, y)
    keys = list(keys or df.columns)
    uniform = text_uniform if portable else hash_uniform
    block = F.floor(text_uniform(keys, seed, 1) * blocks) if portable else F.pmod(F.xxhash64(*keys), F.lit(blocks))
    complete = df.select(block.alias("_block"), a.alias("_x"), b.alias("_y")).where(
        "_x is not null and _y is not null"
    )
    facts = _facts(
        complete.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.avg("_x").alias("mean")),
        mean=F.col("mean"),
        grid=_grid(points),
    )
    # Sums are taken around the mean, so large x values do not cancel out.
    sums = (
        complete.withColumn("_x", F.col("_x") - facts["mean"])
        .groupBy("_block")
        .agg(
            F.count("*").cast("double").alias("n"),
            F.sum("_x").alias("sx"),
            F.sum("_y").alias("sy"),
            F.sum(F.col("_x") * F.col("_x")).alias("sxx"),
            F.sum(F.col("_x") * F.col("_y")).alias("sxy"),
        )
    )
    weight = sum(((F.col("_u") > p).cast("int") for p in POISSON_STEPS), F.lit(0))
    sums = (
        sums.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("_rep"))
        .withColumn("_u", uniform(["_block", "_rep"], seed))
        .withColumn("_w", weight)
        .groupBy("_rep")
        .agg(*[F.sum(F.col("_w") * F.col(m)).alias(m) for m in ("n", "sx", "sy", "sxx", "sxy")])
    )
    slope = F.try_divide(
        F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
        F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"),
    )
    lines = sums.select(slope.alias("slope"), "n", "sx", "sy").select(
        "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept")
    )
    tail = (1.0 - level) / 2.0
    # From here on: replicates x points rows, both parameters.
    return (
        lines.select(F.lit(facts).alias("facts"), "slope", "intercept")
        .select("slope", "intercept", "facts.mean", F.inline("facts.grid"))
        .select("x", (F.col("intercept") + F.col("slope") * (F.col("x") - F.col("mean"))).alias("fit"))
        .groupBy("x")
        .agg(
            F.percentile("fit", F.lit(tail)).alias("lo"),
            F.percentile("fit", F.lit(1.0 - tail)).alias("hi"),
        )
    )


def _facts(row: DataFrame, **fields: Column) -> Column:
    """A struct of values from a one-row frame, as one scalar subquery.

    Every mention of a subquery is planned anew, so what can be derived is
    derived inside and each field is mentioned once.
    """
    return row.select(F.struct(*[value.alias(name) for name, value in fields.items()])).scalar()


def _grid(points: int) -> Column:
    """An even grid from lo to hi as an array of (i, x)."""
    step = (F.col("hi") - F.col("lo")) / F.lit(max(points - 1, 1))
    return F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.struct(i.alias("i"), (F.col("lo") + step * i).alias("x")),
    )


def histogram(df: DataFrame, c: str = "Risk_Score", bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins from min to max; the last bin includes the max.

    Empty bins are listed with 0. Equal values all around get the range value +- 0.5.
    """
    values = df.select(without_nan(c).alias("_v")).where("_v is not null")
    ends = values.agg(F.min("_v").alias("least"), F.max("_v").alias("most"))
    margin = F.when(F.col("least") == F.col("most"), 0.5).otherwise(0.0)
    ends = ends.select((F.col("least") - margin).alias("lo"), (F.col("most") + margin).alias("hi"))
    facts = _facts(
        ends, lo=F.col("lo"), hi=F.col("hi"), width=(F.col("hi") - F.col("lo")) / F.lit(bins)
    )
    counts = (
        values.select(F.least(F.width_bucket("_v", facts["lo"], facts["hi"], F.lit(bins)), F.lit(bins)).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    lo = facts["lo"] + facts["width"] * (F.col("bin") - 1)
    # `counts` has at most `bins` rows.
    return (
        every.join(F.broadcast(counts), "bin", "left")
        .select("bin", lo.alias("lo"), F.coalesce("n", F.lit(0)).alias("n"))
        .select("bin", "lo", (F.col("lo") + facts["width"]).alias("hi"), "n")
    )


def density(
    df: DataFrame,
    c: str = "Risk_Score",
    points: int = 200,
    bins: int | None = None,
) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid from min to max.

    Equal values are counted first, so the work per grid point grows with the
    number of distinct values. With `bins` the curve is scaled to counts per
    histogram bin, as drawn over a histogram. Null where all values are equal.
    """
    values = df.select(without_nan(c).alias("_v")).where("_v is not null")
    width = F.nullif("sd", F.lit(0.0)) * F.pow("n", F.lit(-0.2))
    area = F.lit(1.0) if bins is None else F.col("n") * (F.col("hi") - F.col("lo")) / F.lit(bins)
    facts = _facts(
        values.agg(
            F.min("_v").alias("lo"),
            F.max("_v").alias("hi"),
            F.count("_v").cast("double").alias("n"),
            F.stddev_samp("_v").alias("sd"),
        ),
        width=width,
        scale=F.try_divide(area, F.col("n") * width * F.lit(math.sqrt(2.0 * math.pi))),
        grid=_grid(points),
    )
    u = F.try_divide(F.col("x") - F.col("_v"), F.col("width"))
    return (
        values.groupBy("_v")
        .agg(F.count("*").alias("_n"))
        .select("_v", "_n", F.lit(facts).alias("facts"))
        .select("_v", "_n", "facts.width", "facts.scale", F.inline("facts.grid"))
        .select("x", (F.col("_n") * F.exp(u * u * F.lit(-0.5)) * F.col("scale")).alias("_k"))
        .groupBy("x")
        .agg(F.sum("_k").alias("density"))
    )


def _ranked(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """Distinct values per key with their count, their rank and the key's size.

    Equal values are counted first, then a distributed running total gives the
    rank, so no task holds a whole group.
    """
    values = df.select(*keys, without_nan(c).alias("_v")).where("_v is not null")
    counts = values.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    return prefix_sum(counts, keys, ["_v"], "_n", "_upto", total="n", slice_name="_slice")


def _quantiles_of(ranked: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    def value_at(rank: Column) -> Column:
        inside = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(inside, F.col("_v")))

    picks, out = [], []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("n") - 1)
        picks += [value_at(F.floor(place)).alias(f"_lo{i}"), value_at(F.ceil(place)).alias(f"_hi{i}")]
        share = place - F.floor(place)
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share).alias(f"q_{i}"))
    return ranked.groupBy(*keys, "n").agg(*picks).select(*keys, "n", *out)


def exact_quantiles(df: DataFrame, keys: Sequence[str], c: str, probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles per group: keys, n, q_0, q_1, ...

    Exact for groups of any size.
    """
    return _quantiles_of(_ranked(df, list(keys), c), list(keys), probs)


def box_stats(df: DataFrame, group: str = "Period", c: str = "Price", reach: float = 1.5) -> DataFrame:
    """Box-plot figures per group: quartiles, whiskers, number of outliers.

    Whiskers end at the last value within `reach` interquartile ranges of the
    box, and never inside it.
    """
    ranked = _ranked(df.where(F.col(group).isNotNull()), [group], c)
    boxes = _quantiles_of(ranked, [group], [0.25, 0.5, 0.75]).select(
        group, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3")
    )
    # Hand the box to every slice of its group, then join slice by slice: a hot group stays split.
    per_slice = ranked.select("_slice", group).distinct().join(boxes, group)
    span = (F.col("q3") - F.col("q1")) * F.lit(reach)
    inside = F.col("_v").between(F.col("q1") - span, F.col("q3") + span)
    return (
        ranked.join(per_slice, ["_slice", group])
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("_min"),
            F.max(F.when(inside, F.col("_v"))).alias("_max"),
            F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
        )
        .select(
            group, "n", "q1", "median", "q3",
            F.least("_min", "q1").alias("whisker_lo"),
            F.greatest("_max", "q3").alias("whisker_hi"),
            "outliers",
        )
    )


def summary(df: DataFrame) -> DataFrame:
    """Row count, date range, maxima and r to three places, one row."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
        F.max("Risk_Score").alias("max_risk"),
        F.max("Price").alias("max_price"),
        F.round(safe_corr("Risk_Score", "Price"), 3).alias("r"),
    )


def uplift(df: DataFrame, cutoff_year: int = fixed.CUTOFF_YEAR) -> DataFrame:
    """Peak price against the mean price before the cutoff year, in percent."""
    before = F.when(F.year("full_date") < cutoff_year, F.col("Price"))
    row = df.agg(F.max("Price").alias("peak_price"), F.avg(before).alias("baseline_price"))
    return row.select(
        "*", ((F.try_divide(F.col("peak_price"), F.col("baseline_price")) - 1) * 100).alias("uplift_pct")
    )
