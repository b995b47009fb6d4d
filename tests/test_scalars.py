import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from swellmark.functions import scalars
from swellmark.functions.moments import safe_corr

COMPLETE = statistics.correlation([1.0, 2.0, 3.0], [2.0, 4.0, 6.5])


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_day_key_strips_then_cuts(spark):
    rows = ["2023-10-19T05:00Z", "20231019", "2023", "abc", "", None, "19/10/2023 05:00"]
    assert values(spark, rows, scalars.day_key("s")) == [20231019, 20231019, 2023, None, None, None, 19102023]


def test_parse_day_gives_null_for_bad_dates(spark):
    got = values(spark, ["20231019", "20231019T05", "2023", "20231399", "x", None], scalars.parse_day("s"))
    assert [str(g) if g else None for g in got] == ["2023-10-19", "2023-10-19", None, None, None, None]


def test_parse_ts(spark):
    got = values(spark, ["2023-10-19", "2023-10-19 05:00:01", "nope"], scalars.parse_ts("s"))
    assert [str(g) if g else None for g in got] == ["2023-10-19 00:00:00", "2023-10-19 05:00:01", None]


def test_parse_tone_spellings(spark):
    rows = ["-3.5", " -3.5 ", "", "  ", "x", "1.5d", "1_0", "1e2", ".5", "5.", "inf", None]
    got = values(spark, rows, scalars.parse_tone("s"))
    assert got == [-3.5, -3.5, None, None, None, None, None, 100.0, 0.5, 5.0, math.inf, None]
    assert math.isnan(values(spark, ["NaN"], scalars.parse_tone("s"))[0])


def test_first_non_empty_takes_blanks_but_not_empty(spark):
    df = spark.createDataFrame([("", " ", "c"), (None, "", "c"), ("a", "b", "c")], "x string, y string, z string")
    got = [r[0] for r in df.select(scalars.first_non_empty(["x", "y", "z"])).collect()]
    assert got == [" ", "c", "a"]


def test_conflict_intensity_is_a_sign_flip(spark):
    df = spark.createDataFrame([(-3.0,), (2.0,), (None,)], "t double")
    assert [r[0] for r in df.select(scalars.conflict_intensity("t")).collect()] == [3.0, -2.0, None]


def test_hash_normal_is_reproducible_and_normal(spark):
    df = spark.range(20000).repartition(4)
    draw = scalars.hash_normal(["id"], -5.0, 2.0, seed=3)
    first = [r[0] for r in df.select(draw.alias("z"), "id").orderBy("id").collect()]
    again = [r[0] for r in df.repartition(7).select(draw.alias("z"), "id").orderBy("id").collect()]
    assert first == again
    assert statistics.mean(first) == pytest.approx(-5.0, abs=0.06)
    assert statistics.stdev(first) == pytest.approx(2.0, abs=0.05)
    other = [r[0] for r in df.select(scalars.hash_normal(["id"], -5.0, 2.0, seed=4).alias("z"), "id").orderBy("id").collect()]
    assert other != first


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.125,), (2.675,)], "x double")
    assert df.select(scalars.rounded("x")).first()[0] == 0.12
    assert df.select(scalars.rounded("x", half_even=False)).first()[0] == 0.13


def test_rounding_equals_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.append(rng.normal(0, 5000, 4000), rng.integers(-90000, 90000, 4000) / 1000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    for digits in (0, 1, 2, 4):
        got = [r[0] for r in df.orderBy("i").select(scalars.rounded("x", digits)).collect()]
        assert got == list(np.round(values, digits))


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], COMPLETE),
        ([(1.0, 2.0), (2.0, 4.0), (float("nan"), 9.0), (3.0, 6.5), (None, 1.0), (7.0, None)], COMPLETE),
        ([(1.0, 5.0), (2.0, 5.0)], None),
        ([(1.0, 5.0)], None),
        ([], None),
    ],
)
def test_safe_corr(spark, pairs, want):
    got = spark.createDataFrame(pairs, "x double, y double").agg(safe_corr("x", "y")).first()[0]
    assert got == (None if want is None else pytest.approx(want))


def test_kpi_number_format_is_half_even(spark):
    assert spark.range(1).select(F.format_number(F.lit(8500.5), 0)).first()[0] == "8,500"
