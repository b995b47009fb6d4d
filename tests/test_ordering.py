import numpy as np
import pytest
from pyspark.sql import functions as F

from swellmark.operators import stats
from swellmark.operators.ordering import cap_per_group, dense_ids, prefix_sum


def skewed(spark, n=6000):
    """A third of all rows are copies of one row; one day holds most of the rest."""
    return spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "20240102").when(F.col("id") % 10 == 1, "20240101").otherwise("20240103").alias("Day"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 700)).alias("url"),
    )


def test_ids_are_dense_and_follow_the_order(spark):
    rows = dense_ids(skewed(spark), "Day", ["url"]).orderBy("GlobalEventID").collect()
    assert [r.GlobalEventID for r in rows] == list(range(100000, 106000))
    keys = [(r.Day, r.url) for r in rows]
    assert keys == sorted(keys)


def test_ids_with_a_unique_column_and_own_start(spark):
    df = skewed(spark, 300).withColumn("k", F.monotonically_increasing_id())
    rows = dense_ids(df, "Day", ["url"], start=5, unique_by="k", name="n").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(5, 305))
    assert "k" in rows[0].asDict()


def test_ids_of_nothing(spark):
    assert dense_ids(skewed(spark).where("false"), "Day", ["url"]).count() == 0


def test_copies_are_spread_over_tasks(spark):
    from swellmark.operators.ordering import _range_sorted

    copies = spark.range(8000, numPartitions=8).select(F.lit("a").alias("k")).withColumn("tie", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in _range_sorted(copies, ["k", "tie"]).groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) < 2500


@pytest.mark.parametrize("n", [1, 7, 250, 5000])
def test_cap_equals_brute_force(spark, n):
    df = skewed(spark).withColumn("tie", F.col("url"))
    got = sorted((r.Day, r.url) for r in cap_per_group(df, "Day", ["url"], n).collect())
    want = []
    per_day = {}
    for r in df.collect():
        per_day.setdefault(r.Day, []).append(r.url)
    for day, urls in per_day.items():
        want += [(day, u) for u in sorted(urls)[:n]]
    assert got == sorted(want)


def test_cap_limits_before_the_shuffle(spark):
    plan = cap_per_group(skewed(spark), "Day", ["url"], 250)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3


def test_prefix_sum_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [("big" if i % 5 else "small", float(v), int(c)) for i, (v, c) in enumerate(
        zip(rng.permutation(4000), rng.integers(1, 9, 4000)))]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(5)
    got = {(r.g, r.v): r.upto for r in prefix_sum(df, ["g"], ["v"], "n", "upto").collect()}
    total = {}
    for g, v, c in sorted(rows):
        total[g] = total.get(g, 0) + c
        assert got[(g, v)] == total[g]


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    values = {"a": rng.lognormal(3, 2, 5000).round(1), "b": np.array([4.0]), "c": np.array([1.0, 1.0, 1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("a", float("nan")), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: list(r)[2:] for r in stats.exact_quantiles(df, ["g"], "v", probs).collect()}
    assert sorted(got) == ["a", "b", "c"]
    for key, vs in values.items():
        assert got[key] == pytest.approx(list(np.quantile(vs, probs)))
