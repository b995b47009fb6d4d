"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Document rates w in (0, 2) are the ones closest in entropy to 1 each for which
every source's taken words meet its target. They are exponentially tilted,
w = 2 * t / (1 + t) with t = exp(lambda * size / mean size), where the source's
dual variable lambda solves a convex problem in one unknown. Newton steps, kept
inside a bracket, find all of them at once: an iteration is one aggregation over
documents counted by source and size, since a rate depends on nothing else.

Rounding into copies goes by (source, size) as well: running totals of expected
copies from long to short documents are rounded, then short documents make up
for the words still missing or too many. Which documents of a size get the extra
copy is decided by their hashes, ranked inside salted groups with quotas, so no
task ranks a whole source.

Windows over all sources, and over the sizes of one source, hold a row per source
and per distinct size; neither grows with the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import stored

#: By the sources' order, repeating; part of all words that the mix takes; copies at most.
WEIGHTS, SHARE, COPIES = (3, 1, 2), 1.5, 2

#: Newton iterations at most; words by which a source may miss its target before rounding.
ITERATIONS, TOLERANCE = 60, 0.25

#: Single documents that may be added or left out to come nearer to a target.
FITS = 3

#: Documents ranked together.
GROUP = 20_000


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """`doc_id`, `source`, `size`, `source_size`, `target`, `rate`, `copies`, `taken` for every row of `docs`.

    A size is the number of words (runs of characters other than 0x20 and 0x09-0x0D), a null text's 0.
    Sources in the order of code points, null last, share `share` times all sizes
    by the repeating `weights`; a target stops at twice its source's size and the
    excess goes to the others by weight. taken is copies * size.

    Documents without a word have rate and copies 1 and take nothing; a null
    source is a source, a null id an id. Which of several rows alike in id, source
    and size gets an extra copy is open. No rows give no rows. Other columns are
    ignored. Reruns agree.
    """
    sizes, plan = _planned(docs, weights, share, id_col, text_col, source_col)
    rows = sizes.join(plan, ["key", "size"]).withColumn("h", F.xxhash64("doc_id"))
    rows = _dealt(rows, ["key", "size"], "extra", ["h", "doc_id"], F.expr(f"pmod(h, greatest(1, n div {GROUP}))"))
    rows = rows.withColumn("copies", F.col("base") + F.col("more"))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _planned(
    docs: DataFrame, weights: tuple[float, ...], share: float, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, DataFrame]:
    """Stored sizes of all rows, and by source and size how many copies all get and how many rows get one more."""
    sizes = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        _size(F.col(text_col)).alias("size"),
        _key(F.col(source_col)).alias("key"),
        _mark(docs, id_col, text_col).alias("mark"),
    )
    sizes = stored(sizes, "sizes")
    cells = stored(sizes.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = stored(_targets(cells, weights, share), "sources")
    duals = _balance(cells, sources)
    return sizes, stored(_rounded(cells.drop("source"), sources, duals), "plan")


def _mark(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A number of the row's id and text: equal only for rows alike in both."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _dealt(rows: DataFrame, cell: list[str], quota: str, order: list[str], group: Column) -> DataFrame:
    """Add `more`: 1 for the first `quota` rows of each cell by (group, order), else 0.

    Ranks run inside groups, whose counts say where each begins.
    """
    rows = rows.withColumn("group", group)
    groups = rows.groupBy(*cell, "group").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy(*cell).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    rows = rows.join(groups, [*cell, "group"])
    place = F.row_number().over(Window.partitionBy(*cell, "group").orderBy(*order))
    return rows.withColumn("more", (place + F.col("before") <= F.col(quota)).cast("int")).drop("group", "before")


def mixed_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of `docs`, columns as they are, each as often as the mix takes it.

    By source and size, the rows with the smallest hashes of id and text get the extra copy,
    as many as `mix_sources` gives one. So what decides is a table by source and size, and
    texts stay where they are; only rows alike in id and text of which some get the extra copy
    and some do not are ranked, in groups by input partition.
    """
    sizes, plan = _planned(docs, weights, share, id_col, text_col, source_col)
    # How many rows of a cell have smaller marks: running counts over groups of marks, then inside them.
    marks = sizes.groupBy("key", "size", "mark").agg(F.count(F.lit(1)).alias("alike"))
    marks = marks.join(plan.where("extra > 0").select("key", "size", "n", "extra"), ["key", "size"])
    # Signed marks in equal slices, in order.
    slices = f"greatest(1, n div {GROUP})"
    marks = marks.withColumn("slice", F.expr(f"cast(floor((mark / 18446744073709551616D + 0.5D) * {slices}) as long)"))
    held = marks.groupBy("key", "size", "slice").agg(F.sum("alike").alias("here"))
    earlier = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0))).drop("here")
    line = Window.partitionBy("key", "size", "slice").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("inside", F.coalesce(F.sum("alike").over(line), F.lit(0)))
    marks = marks.join(held, ["key", "size", "slice"]).withColumn("smaller", F.col("before") + F.col("inside"))
    # The mark that uses up the cell's extra copies, and how many rows alike in it still get one.
    last = marks.where("smaller < extra and smaller + alike >= extra")
    last = last.select("key", "size", F.col("mark").alias("edge"), (F.col("extra") - F.col("smaller")).alias("left"), "alike")
    cells = stored(plan.select("key", "size", "base").join(last, ["key", "size"], "left"), "copies")

    own = [f"{name}_{_unused(docs)}" for name in ("key", "size", "mark")]
    names = dict(zip(("key", "size", "mark"), own))
    marked = docs.select(
        "*",
        _key(F.col(source_col)).alias(names["key"]),
        _size(F.col(text_col)).alias(names["size"]),
        _mark(docs, id_col, text_col).alias(names["mark"]),
    )
    found = F.struct(F.col("base"), F.col("edge"), F.col("left"), F.col("alike"))
    table = cells.select(F.col("key").alias(names["key"]), F.col("size").alias(names["size"]), found.alias(f"cell_{names['key']}"))
    # By source and size: Spark sends a small table to all tasks.
    met = marked.join(table, [names["key"], names["size"]])
    cell, mark = F.col(f"cell_{names['key']}"), F.col(names["mark"])
    shared = (mark == cell["edge"]) & (cell["left"] < cell["alike"])
    plain = met.where(~F.coalesce(shared, F.lit(False)))
    extra = F.coalesce((mark <= cell["edge"]).cast("int"), F.lit(0))
    plain = plain.withColumn(names["mark"], cell["base"] + extra)
    # Rows alike, of which only some get one more.
    tied = met.where(F.coalesce(shared, F.lit(False))).select(
        F.struct(*met.columns).alias("row"),
        *[F.col(names[k]).alias(k) for k in ("key", "size")],
        cell["left"].alias("quota"),
        F.spark_partition_id().alias("part"),
    )
    dealt = _dealt(tied, ["key", "size"], "quota", ["part"], F.col("part"))
    own_row = F.col("row")
    number = own_row[f"cell_{names['key']}"]["base"] + F.col("more")
    dealt = dealt.select(*[own_row[c].alias(c) for c in docs.columns], number.alias(names["mark"]))
    both = plain.select(*docs.columns, names["mark"]).unionByName(dealt)
    copies = F.explode(F.sequence(F.lit(1), F.col(names["mark"])))
    return both.where(F.col(names["mark"]) > 0).withColumn(names["key"], copies).select(*docs.columns)


def _unused(docs: DataFrame) -> str:
    """A word that no column's name holds."""
    word = "own"
    while any(word in name for name in docs.columns):
        word += "_"
    return word


def _targets(cells: DataFrame, weights: tuple[float, ...], share: float) -> DataFrame:
    """A row per source with its target: the level at which weights are filled up to the caps."""
    totals = cells.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")
    )
    every = F.array(*(F.lit(float(w)) for w in weights))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    totals = totals.withColumn("weight", F.get(every, (number % len(weights)).cast("int")))
    totals = totals.withColumn("ratio", COPIES * F.col("source_size") / F.col("weight"))
    line = Window.orderBy("ratio", "key")
    everything = Window.partitionBy()
    spent = F.coalesce(
        F.sum(COPIES * F.col("source_size")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    totals = totals.withColumn("level", (share * F.sum("source_size").over(everything) - spent) / rest)
    totals = totals.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "key", "level"))).over(everything)["level"])
    target = F.least(COPIES * F.col("source_size").cast("double"), F.col("weight") * F.col("level"))
    return totals.select(
        "key", "source_size", "docs", F.coalesce(target, COPIES * F.col("source_size").cast("double")).alias("target")
    )


def _rate(dual: str = "dual") -> str:
    """Twice the logistic function, written so that no exponential overflows."""
    x = f"({dual} * size / mean)"
    return f"{COPIES} / (1 + exp(least(-1 * {x}, 700D)))"


def _balance(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """`key`, `mean`, `dual` of the sources whose targets lie inside their bounds."""
    inner = sources.where(f"source_size > 0 and target > 0 and target < {COPIES} * source_size * (1 - 1e-12)")
    state = stored(
        inner.selectExpr("key", "target", "source_size / docs as mean", "0D as dual", "-1e7 as lo", "1e7 as hi"), "duals"
    )
    counted = cells.select("key", "size", "n").where("size > 0")
    for _ in range(ITERATIONS):
        # Value and slope of the dual's gradient.
        sums = counted.join(state, "key").withColumn("rate", F.expr(_rate())).groupBy("key").agg(
            F.sum(F.expr("n * size * rate")).alias("value"),
            F.sum(F.expr(f"n * size * (size / mean) * rate * (1 - rate / {COPIES})")).alias("slope"),
        )
        step = state.join(sums, "key")
        step = step.withColumn("lo", F.expr("if(value < target, dual, lo)"))
        step = step.withColumn("hi", F.expr("if(value < target, hi, dual)"))
        step = step.withColumn("next", F.expr("if(slope > 0, dual + (target - value) / slope, lo)"))
        # Outside the bracket: its middle; twofold steps while a side is unknown.
        middle = "case when hi >= 1e7 then 2 * greatest(dual, 1D) when lo <= -1e7 then 2 * least(dual, -1D) else (lo + hi) / 2 end"
        step = step.withColumn("next", F.expr(f"if(next > lo and next < hi, next, {middle})"))
        far = f"abs(value - target) > {TOLERANCE}"
        step = step.selectExpr(
            "key", "target", "mean", f"if({far}, next, dual) as dual", "lo", "hi", f"{far} as far"
        )
        step = stored(step, "duals")
        state = step.drop("far")
        if step.where("far").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"sources did not come near their targets in {ITERATIONS} iterations")
    return state.select("key", "mean", "dual")


def _rounded(cells: DataFrame, sources: DataFrame, duals: DataFrame) -> DataFrame:
    """By source and size: the rate, the copies that all documents get, and how many get one more."""
    rated = cells.join(sources, "key").join(duals, "key", "left")
    full = f"case when size = 0 then 1D when target >= {COPIES} * source_size * (1 - 1e-12) then {COPIES}D else 0D end"
    rated = rated.withColumn("rate", F.expr(f"if(size > 0 and dual is not null, {_rate()}, {full})"))
    rated = rated.withColumn("base", F.floor("rate").cast("int"))
    down = Window.partitionBy("key").orderBy(F.col("size").desc())
    total = F.round(F.sum(F.expr("n * (rate - base)")).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    rated = rated.withColumn("total", total)
    rated = rated.withColumn("extra", F.col("total") - F.coalesce(F.lag("total").over(down), F.lit(0)))
    whole = Window.partitionBy("key")
    missing = F.col("target") - F.sum(F.expr("(base * n + extra) * size")).over(whole)
    room = f"case when size = 0 or rate >= {COPIES} then 0D when missing > 0 then n - extra else extra end"
    # Short documents first, as many as fit; then, a few times, the one document that fits best.
    rated = rated.withColumn("missing", missing).withColumn("room", F.expr(room))
    up = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn("used", F.coalesce(F.sum(F.expr("room * size")).over(up), F.lit(0)))
    change = "if(size = 0, 0, sign(missing) * least(room, floor(greatest(abs(missing) - used, 0) / greatest(size, 1))))"
    rated = rated.withColumn("extra", F.col("extra") + F.expr(change))
    for _ in range(FITS):
        rated = rated.withColumn("missing", missing).withColumn("room", F.expr(room))
        fit = F.expr("if(room >= 1 and abs(abs(missing) - size) < abs(missing), struct(abs(abs(missing) - size), size), null)")
        rated = rated.withColumn("fit", F.min(fit).over(whole)["size"])
        rated = rated.withColumn("extra", F.col("extra") + F.expr("if(size = fit, sign(missing), 0)"))
    rated = rated.withColumn("extra", F.col("extra").cast("long"))
    return rated.select("key", "size", "n", "source_size", "target", "rate", "base", "extra")
