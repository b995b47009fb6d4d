from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from swellmark.operators import series
from swellmark.operators.tone import lexicon_tone

D0 = date(2024, 1, 1)


def daily(spark, rows):
    return spark.createDataFrame(
        [(k, D0 + timedelta(days=d), float(p), float(r)) for k, d, p, r in rows],
        "Route string, day date, avg_price double, Risk_Score double",
    ).withColumnRenamed("avg_price", "close_price").selectExpr("*", "close_price as avg_price")


def test_to_daily(spark):
    rows = [(datetime(2024, 1, 1, h), float(h), 5, 2.0) for h in range(24)] + [(datetime(2024, 1, 2), 9.0, 1, 3.0)]
    gold = spark.createDataFrame(rows, "full_date timestamp_ntz, Price double, news_count long, avg_conflict_score double")
    first, second = series.to_daily(gold).orderBy("day").collect()
    assert (first.avg_price, first.close_price, first.news_count, first.Risk_Score) == (11.5, 23.0, 5, 10.0)
    assert (second.close_price, second.Risk_Score) == (9.0, 3.0)


def test_planted_lag_is_found_in_spite_of_gaps(spark):
    rng = np.random.default_rng(3)
    risk = rng.normal(0, 1, 200)
    days = [d for d in range(200) if d % 7 != 3]
    rows = [("a", d, risk[d - 12] if d >= 12 else 0.0, risk[d]) for d in days]
    rows += [("b", d, risk[d - 4] if d >= 4 else 0.0, risk[d]) for d in days]
    scan = series.lag_scan(daily(spark, rows), 30, ["Route"])
    best = {r.Route: (r.lag, round(r.r, 3)) for r in scan.where("rank = 1").collect()}
    assert best["a"][0] == 12 and best["b"][0] == 4
    assert scan.count() == 62
    whole = series.lag_scan(daily(spark, [r for r in rows if r[0] == "a"]), 30)
    assert whole.where("rank = 1").first().lag == 12


def test_lag_scan_equals_a_join_by_date(spark):
    rng = np.random.default_rng(4)
    days = sorted(rng.choice(80, 50, replace=False).tolist())
    rows = [("a", d, rng.normal(), rng.normal()) for d in days]
    got = {r.lag: (r.n, r.r) for r in series.lag_scan(daily(spark, rows), 10).collect()}
    by_day = {d: (p, r) for _, d, p, r in rows}
    for lag in range(11):
        pairs = [(by_day[d][1], by_day[d + lag][0]) for d in days if d + lag in by_day]
        frame = pd.DataFrame(pairs)
        assert got[lag][0] == len(pairs)
        assert got[lag][1] == pytest.approx(frame[0].corr(frame[1]))


def test_cumulative_risk(spark):
    rows = [("a", d, 1.0, d + 1) for d in range(4)] + [("b", 0, 1.0, 5), ("b", 9, 1.0, -2)]
    got = series.cumulative_risk(daily(spark, rows), ["Route"]).orderBy("Route", "day").collect()
    assert [r.cumulative_risk for r in got] == [1, 3, 6, 10, 5, 3]
    whole = series.cumulative_risk(daily(spark, rows[:4])).orderBy("day").collect()
    assert [r.cumulative_risk for r in whole] == [1, 3, 6, 10]


def test_volatility(spark):
    rng = np.random.default_rng(6)
    price = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 60)))
    rows = [("a", d, p, 0.0) for d, p in enumerate(price)]
    got = series.volatility(daily(spark, rows), 7, ["Route"]).orderBy("day").toPandas()
    want = pd.Series(price).pct_change()
    assert np.allclose(got.daily_return.astype(float), want, equal_nan=True)
    assert np.allclose(got.rolling_sd.astype(float), want.rolling(7, min_periods=2).std(), equal_nan=True)
    squares = want**2
    row = series.volatility_clustering(daily(spark, rows), ["Route"]).first()
    assert row.autocorrelation == pytest.approx(squares.corr(squares.shift(1))) and row.n == 58


def test_zero_price_gives_no_return(spark):
    got = series.daily_returns(daily(spark, [("a", 0, 0.0, 0), ("a", 1, 2.0, 0)])).orderBy("day").collect()
    assert [r.daily_return for r in got] == [None, None]


def test_lexicon_tone(spark):
    docs = spark.createDataFrame(
        [(1, "Good, good: BAD!"), (2, "nothing here"), (3, ""), (4, None), (5, "été bad été"), (6, "goods")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.Tone for r in lexicon_tone(docs, ["good"], ["bad"]).collect()}
    assert got[1] == pytest.approx(100 / 3) and got[2] == 0.0 and got[6] == 0.0
    assert got[3] is None and got[4] is None and got[5] == pytest.approx(-100 / 3)
