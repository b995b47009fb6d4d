"""Radix selection, sketches, fast density, neighbours."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swellmark.operators import density, ordering, selection, series, sketches, stats, upsample
from swellmark.session import scratch_path

INF, NAN = math.inf, math.nan


def _frame(spark, rows, schema="g string, v double"):
    return spark.createDataFrame(rows, schema)


def test_order_keys_follow_the_bits_of_doubles(spark):
    rng = np.random.default_rng(1)
    drawn = rng.integers(0, 2047 << 52, 4000, dtype=np.int64).view(np.float64)
    powers = 2.0 ** np.arange(-1074, 1024, 7)
    near = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, INF)])
    edges = [0.0, INF, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 2.225073858507201e-308]
    values = np.concatenate([drawn, near, edges])
    values = np.concatenate([values, -values])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = selection.with_order_key(df, "v", "k").withColumn("back", selection.key_value(F.col("k"))).toPandas()
    bits = np.abs(got.v.to_numpy()).view(np.int64)
    assert (got.k.to_numpy() == np.where(got.v < 0, -bits, bits)).all()
    assert (got.back == got.v).all()
    missing = selection.with_order_key(_frame(spark, [("a", None), ("a", NAN)]), "v", "k").collect()
    assert [r.k for r in missing] == [None, None]


@pytest.mark.parametrize("rescan", [False, True])
def test_radix_quantiles_agree_with_sorting(spark, rescan):
    rng = np.random.default_rng(4)
    rows = [("hot", 5.0)] * 3000 + [("hot", float(v)) for v in rng.normal(size=2000)]
    rows += [("few", 1.0), ("few", 2.0), ("few", 4.0), ("one", -7.5), (None, 3.0), (None, 9.0), ("none", None), ("none", NAN)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    df = _frame(spark, rows).repartition(5)
    got = {r.g: r for r in selection.radix_quantiles(df, ["g"], "v", probs, rescan).collect()}
    assert set(got) == {"hot", "few", "one", None}
    for g, row in got.items():
        values = [v for k, v in rows if k == g]
        assert row.n == len(values)
        want = np.quantile(values, probs)
        assert np.allclose([row[f"q_{i}"] for i in range(len(probs))], want, rtol=1e-15, atol=0)
    whole = selection.radix_quantiles(df, [], "v", [0.5]).collect()
    assert len(whole) == 1 and whole[0].n == 5006


def test_radix_quantiles_take_every_pass_for_close_values(spark):
    # More equal top digits than a pass has cells: values next to each other, 200,000 of them.
    n = 200_000
    df = spark.range(n).selectExpr("'a' as g", "1.0D + id * 2.220446049250313e-16D as v")
    (row,) = selection.radix_quantiles(df, ["g"], "v", [0.25, 0.5]).collect()
    step = 2.220446049250313e-16
    for q, p in ((row.q_0, 0.25), (row.q_1, 0.5)):
        assert abs(q - (1.0 + math.floor(p * (n - 1)) * step)) <= step


def test_radix_quantiles_of_infinite_values_and_nothing(spark):
    rows = [("a", -INF), ("a", 1.0), ("a", INF), ("b", INF), ("b", INF), ("c", -INF), ("c", INF)]
    got = {r.g: (r.q_0, r.q_1) for r in selection.radix_quantiles(_frame(spark, rows), ["g"], "v", [0.5, 0.75]).collect()}
    assert got == {"a": (1.0, INF), "b": (INF, INF), "c": (None, None)}
    assert selection.radix_quantiles(_frame(spark, []), ["g"], "v", [0.5]).count() == 0


def test_cells_beyond_the_small_size_are_joined(spark, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 3)
    df = spark.range(3000).selectExpr("cast(id % 40 as string) as g", "cast(id as double) as v")
    got = selection.radix_quantiles(df, ["g"], "v", [0.5])
    want = stats.exact_quantiles(df, ["g"], "v", [0.5])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("rescan", [False, True])
def test_radix_box_stats_agree(spark, rescan):
    rng = np.random.default_rng(6)
    rows = [("a", float(v)) for v in rng.standard_t(2, size=900)] + [("b", 1.0), ("b", 2.0), (None, 4.0), ("c", None)]
    df = _frame(spark, rows)
    got = selection.radix_box_stats(df, "g", "v", rescan=rescan).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stats.box_stats(df, "g", "v").collect()))


# --------------------------------------------------------------------------- sketches


def _days(spark):
    df = spark.range(60_000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 30 as int)) as full_date",
        "if(id % 7 < 3, 'x', 'y') as Route",
        "if(id % 5 = 0, 7.0D, (id * 7919 % 60007) * 1.5D) as Price",
    )
    return df


def test_sketches_keep_their_rank_error_for_any_window(spark):
    df, path = _days(spark), scratch_path(spark, "test-sketch")
    probs = [0.0, 0.01, 0.3, 0.5, 0.9, 1.0]
    assert sketches.write_sketches(sketches.daily_sketches(df.where("day(full_date) <= 20")), path) == 40
    sketches.write_sketches(sketches.daily_sketches(df.where("day(full_date) > 10")), path)
    stored = sketches.read_sketches(spark, path)
    assert stored.count() == 60 and stored.agg(F.sum("n")).first()[0] == 60_000
    for start, end in (("2024-01-01", "2024-01-30"), ("2024-01-05", "2024-01-12"), (None, None)):
        estimates = sketches.window_quantiles(stored, probs, start=start, end=end)
        part = df if start is None else df.where(f"full_date between '{start}' and '{end} 23:00:00'")
        off = sketches.rank_errors(part, estimates, probs, "Price", ["Route"]).collect()
        assert len(off) == 12 and all(0 <= r.off <= sketches.rank_error() for r in off)
    assert sketches.window_quantiles(stored, probs, start="2030-01-01").count() == 0


def test_a_restated_day_replaces_all_its_keys(spark):
    path = scratch_path(spark, "test-sketch")
    df = _days(spark).where("day(full_date) <= 2")
    sketches.write_sketches(sketches.daily_sketches(df), path)
    sketches.write_sketches(sketches.daily_sketches(df.where("day(full_date) = 2 and Route = 'x'")), path)
    got = {(str(r.day), r.Route) for r in sketches.read_sketches(spark, path).collect()}
    assert got == {("2024-01-01", "x"), ("2024-01-01", "y"), ("2024-01-02", "x")}


def test_a_finer_sketch_errs_less():
    assert sketches.rank_error(800) < sketches.rank_error(200) < 0.02


# --------------------------------------------------------------------------- density


@pytest.mark.parametrize("error", [1e-3, 1e-6, 1e-12])
def test_fast_density_stays_within_its_error(spark, error):
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(size=3000), rng.normal(8, 0.3, 500), rng.pareto(2.5, 800), np.zeros(200)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (NAN,)], "v double")
    direct = stats.density(df, "v", points=150).toPandas().sort_values("x")
    fast = density.fast_density(df, "v", points=150, error=error).toPandas().sort_values("x")
    assert np.allclose(fast.x, direct.x, rtol=0, atol=1e-12)
    width = values.std(ddof=1) * len(values) ** -0.2
    height = 1 / (width * math.sqrt(2 * math.pi))
    assert np.abs(fast.density.to_numpy() - direct.density.to_numpy()).max() <= error * height + 1e-14


def test_fast_density_in_counts_and_odd_inputs(spark):
    df = spark.range(500).selectExpr("cast(id * id % 211 as double) as v")
    direct = stats.density(df, "v", 40, bins=20).toPandas().sort_values("x")
    fast = density.fast_density(df, "v", 40, bins=20).toPandas().sort_values("x")
    assert np.allclose(direct.density, fast.density, rtol=0, atol=1e-6)
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in density.fast_density(flat, "v").collect()] == [(2.0, None)]
    assert density.fast_density(flat.where("v > 3"), "v").count() == 0
    with pytest.raises(ValueError):
        density.fast_density(flat, "v", error=0.0)


def test_terms_grow_with_accuracy():
    assert density.terms_for(1e-3) < density.terms_for(1e-12) < 30
    assert density.reach_for(1e-12) > density.reach_for(1e-3)


# --------------------------------------------------------------------------- neighbours


def _by_hand(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        held = None
        for i, r in enumerate(own):
            held = r[2] if r[2] is not None else held
            out[(key, r[1])] = (
                (own[i - 1][1], own[i - 1][2]) if i else None,
                (own[i + 1][1], own[i + 1][2]) if i + 1 < len(own) else None,
                held,
            )
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b", None]), st.integers(0, 400), st.none() | st.integers(0, 9)), max_size=300))
def test_neighbours_against_plain_lists(spark, rows):
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = ordering.neighbours(df, ["k"], ["t"], ["t", "v"], carried={"held": "v"}).collect()
    found = {(r.k, r.t): (r.before and tuple(r.before), r.after and tuple(r.after), r.held) for r in got}
    assert len(got) == len(rows) and found == _by_hand(rows)


def test_neighbours_of_one_key_over_many_partitions(spark):
    df = spark.range(20_000).selectExpr("id as t", "if(id % 4000 = 17, id, null) as v").repartition(7)
    met = ordering.neighbours(df, [], ["t"], ["t"], carried={"held": "v"})
    wrong = met.where(
        "coalesce(before.t, -1) <> t - 1 or coalesce(after.t, 20000) <> t + 1"
        " or not (held <=> if(t < 17, null, t - (t - 17) % 4000))"
    )
    assert met.count() == 20_000 and wrong.count() == 0


def test_spread_upsampling_and_returns_agree(spark, weekly):
    holed = weekly.withColumn("Price", F.when(F.col("Price") != 1200, F.col("Price")))
    extra = spark.sql(
        "select timestamp_ntz'2024-01-01 00:30:00' as Date, 'lone' as Route, 5.0D as Price union all"
        " select timestamp_ntz'2024-01-01 00:00:00', 'empty', null union all select timestamp_ntz'2024-01-01 03:00:00', 'empty', null"
    )
    both = holed.unionByName(extra)
    plain, spread = upsample.upsample_linear(both), upsample.upsample_linear(both, spread=True)
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0
    daily = plain.selectExpr("Route", "to_date(Date) as day", "Price as close_price").where("hour(Date) = 0")
    one, two = series.daily_returns(daily, ["Route"]), series.daily_returns(daily, ["Route"], spread=True)
    assert one.exceptAll(two).count() == 0 and one.count() == two.count()
