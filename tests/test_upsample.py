from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swellmark.operators import frames, stats
from swellmark.operators.upsample import add_noise, time_spine, upsample_linear, upsample_rates

T0 = datetime(2024, 1, 1)


def series(spark, rows, route="r"):
    return spark.createDataFrame(
        [(T0 + timedelta(minutes=int(h * 60)), route, v) for h, v in rows], "t timestamp_ntz, Route string, Price double"
    ).withColumnRenamed("t", "Date")


def prices(df):
    return [r.Price for r in df.orderBy("Route", "Date").collect()]


def test_price_fixture(spark, weekly):
    hourly = upsample_linear(weekly).cache()
    assert hourly.count() == 2689
    assert hourly.select(F.to_date("Date")).distinct().count() == 113
    ends = frames.bounds(hourly, "Date").first()
    assert (ends[0], ends[1]) == (datetime(2023, 10, 19), datetime(2024, 2, 8))
    at = {r.Date: r.Price for r in hourly.collect()}
    assert at[datetime(2023, 10, 22, 12)] == pytest.approx(1025.0)
    assert at[datetime(2024, 1, 25)] == 8500.0 == max(at.values())
    as_gold = hourly.withColumnRenamed("Date", "full_date")
    assert frames.filter_dates(as_gold, "2023-11-15", "2024-01-31").count() == 1872
    assert frames.filter_instants(as_gold, "2023-11-15", "2024-01-31").count() == 1849


def test_price_fixture_by_period(spark, weekly):
    labelled = frames.with_period(upsample_linear(weekly).withColumnRenamed("Date", "full_date"))
    got = {r.Period: r for r in stats.box_stats(labelled).collect()}
    early, late = got["Baseline (2023)"], got["Crisis (2024)"]
    assert (early.n, late.n) == (1776, 913)
    assert (early.q1, early.median, early.q3) == pytest.approx((1164.1369047619046, 1414.1369047619046, 2436.25))
    assert (late.q1, late.median, late.q3) == pytest.approx((7392.857142857143, 7933.333333333333, 8244.642857142857))
    means = {r.Period: r.m for r in labelled.groupBy("Period").agg(F.avg("Price").alias("m")).collect()}
    assert means["Baseline (2023)"] == pytest.approx(2054.292149292149)
    assert means["Crisis (2024)"] == pytest.approx(7658.332029416368)


@pytest.mark.parametrize(
    "values, want",
    [
        ([1, 3, None], [1, 2, 3, 3, 3]),
        ([None, 3, 5], [None, None, 3, 4, 5]),
        ([1, None, 5], [1, 2, 3, 4, 5]),
        ([None, None, None], [None] * 5),
        ([1, float("nan"), 5], [1, 2, 3, 4, 5]),
    ],
)
def test_null_anchors(spark, values, want):
    rows = [(h, None if v is None else float(v)) for h, v in zip((0, 2, 4), values)]
    assert prices(upsample_linear(series(spark, rows))) == want


def test_no_fill_keeps_anchors_only(spark):
    assert prices(upsample_linear(series(spark, [(0, 1.0), (2, 3.0)]), fill=False)) == [1.0, None, 3.0]


def test_unsorted_single_and_empty_input(spark):
    assert prices(upsample_linear(series(spark, [(2, 3.0), (0, 1.0)]))) == [1.0, 2.0, 3.0]
    assert prices(upsample_linear(series(spark, [(5, 7.0)]))) == [7.0]
    assert prices(upsample_linear(series(spark, []))) == []


def test_off_grid_anchors_use_elapsed_time(spark):
    got = upsample_linear(series(spark, [(0, 0.0), (1.5, 3.0), (1.75, 9.0), (3.75, 1.0)]))
    # 01:00 lies two thirds of the way to 01:30; 02:00 and 03:00 lie between 01:45 and 03:45.
    assert prices(got) == pytest.approx([0.0, 2.0, 8.0, 4.0])


def test_grid_starts_before_an_off_grid_first_anchor(spark):
    assert prices(upsample_linear(series(spark, [(0.5, 1.0), (2.5, 3.0)]))) == [None, 1.5, 2.5]


def test_gap_shorter_than_the_step(spark):
    assert prices(upsample_linear(series(spark, [(0, 0.0), (0.25, 5.0), (0.5, 2.0), (1, 4.0)]))) == [0.0, 4.0]


def test_before_1970(spark):
    df = spark.createDataFrame(
        [(datetime(1969, 12, 31, 22), "r", 0.0), (datetime(1970, 1, 1, 2), "r", 4.0)],
        "Date timestamp_ntz, Route string, Price double",
    )
    assert prices(upsample_linear(df)) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_duplicates_raise_or_last_wins(spark):
    twice = series(spark, [(0, 1.0), (0, 9.0), (1, 2.0)])
    with pytest.raises(Exception, match="duplicate Date"):
        upsample_linear(twice).collect()
    marked = twice.withColumn("loaded", F.col("Price"))
    assert prices(upsample_linear(marked, duplicates="last", last_by="loaded")) == [9.0, 2.0]
    with pytest.raises(ValueError):
        upsample_linear(twice, duplicates="last")


def test_routes_do_not_mix(spark):
    both = series(spark, [(0, 0.0), (2, 2.0)], "a").union(series(spark, [(1, 10.0), (3, 30.0)], "b"))
    assert prices(upsample_linear(both)) == [0.0, 1.0, 2.0, 10.0, 20.0, 30.0]


def test_no_keys_and_other_steps(spark):
    got = upsample_linear(series(spark, [(0, 0.0), (1, 4.0)]).drop("Route"), keys=(), step="15 minutes")
    assert [r.Price for r in got.orderBy("Date").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        upsample_linear(series(spark, []), step="0 hours")


def test_needs_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            upsample_linear(series(spark, [(0, 1.0)]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_spine(spark):
    got = time_spine(series(spark, [(0.5, 1.0), (3, None)]))
    assert [r.Date.hour for r in got.orderBy("Date").collect()] == [0, 1, 2, 3]
    assert time_spine(series(spark, []).drop("Route"), keys=()).count() == 0


def test_noise_is_seeded_and_rounded(spark, weekly):
    clean = upsample_linear(weekly)
    a, b = prices(add_noise(clean, 5.0, 1)), prices(add_noise(clean.repartition(5), 5.0, 1))
    assert a == b
    assert all(round(v, 2) == v for v in a)
    off = pd.Series(a) - pd.Series(prices(clean))
    assert off.std() == pytest.approx(5.0, rel=0.1) and abs(off.mean()) < 0.5
    assert prices(add_noise(clean, 0.0)) == pytest.approx(prices(clean), abs=0.005)


def test_upsample_rates_overwrites_route(spark, weekly):
    got = upsample_rates(weekly.withColumn("Route", F.lit("x")), route="Shanghai-Rotterdam", noise_sd=0.0)
    assert [r[0] for r in got.select("Route").distinct().collect()] == ["Shanghai-Rotterdam"]
    assert got.columns == ["Date", "Route", "Price"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 60), min_size=1, max_size=12, unique=True),
    st.data(),
)
def test_agrees_with_pandas_on_the_grid(spark, hours, data):
    values = data.draw(
        st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4)), min_size=len(hours), max_size=len(hours))
    )
    rows = sorted(zip(hours, values))
    want = (
        pd.Series([v for _, v in rows], index=pd.DatetimeIndex([T0 + timedelta(hours=h) for h, _ in rows]), dtype=float)
        .resample("h")
        .interpolate(method="linear")
    )
    got = prices(upsample_linear(series(spark, rows)))
    assert [None if v is None else round(v, 6) for v in got] == [
        None if pd.isna(v) else pytest.approx(v, abs=1e-5) for v in want
    ]


def test_one_route_is_made_by_several_tasks(spark, weekly):
    grid = upsample_linear(weekly, step="1 minute")
    sizes = [r.n for r in grid.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and sum(sizes) == 112 * 24 * 60 + 1 and max(sizes) < 3 * sum(sizes) / len(sizes)
