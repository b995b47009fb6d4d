"""Price series on a regular time grid: linear upsampling, spine, jitter.

The grid is counted in whole steps since 1970-01-01, so "which grid cell" is
integer arithmetic. Only the first and the last anchor of a cell can influence
a grid point, because grid points lie on cell edges. Grouping by (keys, cell)
first therefore loses nothing, combines on the map side, and leaves per key at
most as many rows as the key has output rows; only then does a window look for
the neighbouring anchor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swellmark import fixed
from swellmark.functions.scalars import hash_normal, rounded, without_nan
from swellmark.operators.ordering import neighbours

MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def step_micros(step: str) -> int:
    """'1 hour', '15 minutes', ... as microseconds."""
    count, unit = step.split()
    size = int(count) * MICROS[unit.rstrip("s")]
    if size <= 0:
        raise ValueError(f"step must be positive: {step!r}")
    return size


#: Longest run of grid points generated from one row at a time.
RUN = 4_096


def _micros(ts: str) -> str:
    return f"unix_micros(cast(`{ts}` as timestamp))"


def _cell(us: str, size: int) -> str:
    """Number of the grid step a time falls into; whole-number arithmetic, also before 1970."""
    return f"({us} - pmod({us}, {size}L)) div {size}L"


def _grid_points(spans: DataFrame, size: int) -> DataFrame:
    """One row per grid number from lo to hi, with its time `us`.

    Long spans are cut into runs first, so no row holds an array of unbounded length.
    Runs are dealt out anew, a few bytes each, so that the points of one key are made
    by all tasks. The number is given, as adaptive execution would merge partitions
    by their size before the points are there.
    """
    runs = spans.selectExpr("*", f"explode(sequence(lo, hi, {RUN}L)) as run")
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = runs.repartition(tasks, "run", "hi").selectExpr("*", f"explode(sequence(run, least(hi, run + {RUN - 1}L))) as point")
    return points.selectExpr("*", f"point * {size}L as us")


GRID_TIME = "cast(timestamp_micros(us) as timestamp_ntz)"


def _require_utc(df: DataFrame) -> None:
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"time grids need a UTC session, not {zone}")


def unique_anchors(
    df: DataFrame,
    ts: str,
    val: str,
    keys: Sequence[str],
    duplicates: str = "error",
    last_by: str | None = None,
) -> DataFrame:
    """One row per (keys, ts). Two rows at one time raise, unless 'last' is asked for.

    'last' needs a column that says which row is the later one.
    """
    if duplicates == "error":
        checked = F.when(F.count("*") > 1, F.raise_error(F.lit(f"duplicate {ts} in price series")))
        value = F.coalesce(checked.cast("double"), F.max(without_nan(val)))
    elif duplicates == "last":
        if last_by is None:
            raise ValueError("duplicates='last' needs last_by")
        value = F.max_by(without_nan(val), F.col(last_by))
    else:
        raise ValueError(f"duplicates must be 'error' or 'last', not {duplicates!r}")
    return df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(value.alias(val))


def upsample_linear(
    df: DataFrame,
    ts: str = "Date",
    val: str = "Price",
    keys: Sequence[str] = ("Route",),
    step: str = "1 hour",
    fill: bool = True,
    duplicates: str = "error",
    last_by: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """Put each key's series on a regular grid, linear in elapsed time between anchors.

    The grid runs from the step that holds the key's first timestamp to the one
    that holds its last. Inside gaps the value is interpolated, after the last
    anchor it is carried on, before the first one it is null. With `fill=False`
    only grid points that hit an anchor have a value. Output: keys, ts, val.

    A window looks for the next anchor, so a task holds all anchors of a key. With
    `spread` range partitions do, and hand each other their outermost anchors: for
    series of many millions of anchors.
    """
    _require_utc(df)
    size = step_micros(step)
    key = [f"`{k}`" for k in keys]

    anchors = unique_anchors(df, ts, val, keys, duplicates, last_by).selectExpr(
        *key, f"{_micros(ts)} as us", f"`{val}` as v", f"if(`{val}` is null, null, {_micros(ts)}) as anchor"
    )
    cells = anchors.groupBy(*key, F.expr(_cell("us", size)).alias("cell")).agg(
        F.min("anchor").alias("first_us"),
        F.min_by("v", "anchor").alias("first_v"),
        F.max("anchor").alias("last_us"),
        F.max_by("v", "anchor").alias("last_v"),
    )

    found = _spread_segments(cells, keys) if spread else _windowed_segments(cells, key)
    segments = found.selectExpr(
        *key,
        "first_us", "first_v", "last_us", "last_v", "next_us", "next_v",
        # A cell's own edge belongs to it when it is hit exactly, or when nothing comes before.
        f"case when is_first then grid_lo when first_us = cell * {size}L then cell else cell + 1 end as lo",
        f"case when next_cell is null then grid_hi when next_us = next_cell * {size}L then next_cell - 1"
        " else next_cell end as hi",
    ).where("lo <= hi")

    if fill:
        value = """case when us = first_us then first_v
            when us >= last_us and next_us is null then last_v
            when us >= last_us then last_v + (next_v - last_v) * ((us - last_us) / (next_us - last_us)) end"""
    else:
        value = "if(us = first_us, first_v, null)"
    return _grid_points(segments, size).selectExpr(f"{GRID_TIME} as `{ts}`", *key, f"{value} as `{val}`")


def _windowed_segments(cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """Cells with an anchor, the next of them, and the ends of their key's grid."""
    whole = "partition by " + (", ".join(key) or "0")
    ordered = f"({whole} order by cell)"
    # Cells without an anchor only stretch the grid; keep one if the key has nothing else.
    ranged = cells.selectExpr(
        "*",
        f"min(cell) over ({whole}) as grid_lo",
        f"max(cell) over ({whole}) as grid_hi",
        f"count(first_us) over ({whole}) as n_anchors",
    ).where("first_us is not null or (n_anchors = 0 and cell = grid_lo)")
    return ranged.selectExpr(
        "*",
        f"lead(cell) over {ordered} as next_cell",
        f"lead(first_us) over {ordered} as next_us",
        f"lead(first_v) over {ordered} as next_v",
        f"row_number() over {ordered} = 1 as is_first",
    )


def _spread_segments(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As `_windowed_segments`, without a task that holds a whole key."""
    totals = cells.groupBy(*keys).agg(
        F.min("cell").alias("grid_lo"), F.max("cell").alias("grid_hi"), F.count("first_us").alias("n_anchors")
    )
    met = neighbours(cells.where("first_us is not null"), keys, ["cell"], ["cell", "first_us", "first_v"])
    met = met.selectExpr(
        "*",
        "after.cell as next_cell", "after.first_us as next_us", "after.first_v as next_v", "before is null as is_first",
    ).drop("before", "after")
    same = F.lit(True)
    ends = totals.toDF(*[f"_of_{i}" for i in range(len(keys))], "grid_lo", "grid_hi", "n_anchors")
    for i, k in enumerate(keys):
        same = same & met[k].eqNullSafe(ends[f"_of_{i}"])
    ranged = met.join(ends, same).drop(*[f"_of_{i}" for i in range(len(keys))])
    alone = totals.where("n_anchors = 0").selectExpr(
        *[f"`{k}`" for k in keys],
        "grid_lo as cell",
        *[f"cast(null as {cells.schema[c].dataType.simpleString()}) as {c}" for c in ("first_us", "first_v", "last_us", "last_v")],
        "cast(null as bigint) as next_cell", "cast(null as bigint) as next_us", "cast(null as double) as next_v",
        "true as is_first", "grid_lo", "grid_hi", "n_anchors",
    )
    return ranged.unionByName(alone)


def time_spine(df: DataFrame, ts: str = "Date", keys: Sequence[str] = ("Route",), step: str = "1 hour") -> DataFrame:
    """Every grid time from each key's first timestamp to its last."""
    _require_utc(df)
    size = step_micros(step)
    key = [f"`{k}`" for k in keys]
    cell = F.expr(_cell(_micros(ts), size))
    ends = df.where(F.col(ts).isNotNull()).groupBy(*key).agg(F.min(cell).alias("lo"), F.max(cell).alias("hi"))
    return _grid_points(ends.where("lo is not null"), size).selectExpr(*key, f"{GRID_TIME} as `{ts}`")


def add_noise(
    df: DataFrame,
    noise_sd: float = fixed.NOISE_SD,
    seed: int = 0,
    ts: str = "Date",
    val: str = "Price",
    keys: Sequence[str] = ("Route",),
    digits: int = 2,
) -> DataFrame:
    """Jitter each price by N(0, noise_sd), then round. Same seed, same numbers."""
    jitter = hash_normal([*keys, ts], 0.0, noise_sd, seed)
    return df.withColumn(val, rounded(F.col(val) + jitter, digits))


def upsample_rates(
    weekly: DataFrame,
    route: str | None = None,
    noise_sd: float = fixed.NOISE_SD,
    seed: int = 0,
    **options,
) -> DataFrame:
    """Weekly price table to hourly price table, with jitter and rounding.

    `route` overwrites the route of every row, as a one-route setup wants it.
    """
    if route is not None:
        weekly = weekly.withColumn("Route", F.lit(route))
    return add_noise(upsample_linear(weekly, **options), noise_sd, seed)
