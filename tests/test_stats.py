from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from swellmark.operators import stats

T0 = datetime(2023, 12, 1)
COLS = ["Price", "news_count", "avg_conflict_score", "Risk_Score"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    n = 400
    count = rng.integers(1, 40, n)
    score = rng.normal(4, 1.5, n).round(2)
    return pd.DataFrame(
        {
            "full_date": [T0 + timedelta(hours=4 * i) for i in range(n)],
            "Price": (1000 + 20 * count + rng.normal(0, 90, n)).round(2),
            "news_count": count,
            "avg_conflict_score": score,
            "Risk_Score": (count * score).round(2),
        }
    )


@pytest.fixture(scope="module")
def df(spark, pdf):
    schema = "full_date timestamp_ntz, Price double, news_count long, avg_conflict_score double, Risk_Score double"
    return spark.createDataFrame(pdf, schema).repartition(6).cache()


def test_kpis(df, pdf):
    row = stats.kpis(df).first()
    assert row.peak_price == pdf.Price.max() and row.total_events == pdf.news_count.sum()
    assert row.correlation == pytest.approx(pdf.Price.corr(pdf.Risk_Score))
    shown = stats.kpis(df, formatted=True).first()
    assert tuple(shown) == (
        f"${pdf.Price.max():,.0f}", f"{pdf.news_count.sum():,.0f}", f"{pdf.Price.corr(pdf.Risk_Score):.2f}",
    )


def test_kpis_without_enough_rows(df):
    one = df.limit(1)
    assert stats.kpis(one).first().correlation is None
    assert stats.kpis(one, formatted=True).first().correlation == "N/A"
    assert tuple(stats.kpis(df.where("false")).first()) == (None, None, None)
    assert tuple(stats.kpis(df.where("false"), formatted=True, placeholder="-").first()) == ("-", "-", "-")


def test_corr_matrix(df, pdf):
    got = {(r.x, r.y): r.r for r in stats.corr_matrix(df).collect()}
    want = pdf[COLS].corr()
    assert len(got) == 16
    for x in COLS:
        for y in COLS:
            assert got[(x, y)] == pytest.approx(want.loc[x, y])


def test_corr_matrix_with_gaps_and_a_constant(spark):
    nan = float("nan")
    pdf = pd.DataFrame({"a": [1.0, 2.0, nan, 4.0, 7.0], "b": [2.0, nan, 3.0, 9.0, 1.0], "c": [5.0] * 5})
    got = {(r.x, r.y): r.r for r in stats.corr_matrix(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for key, value in got.items():
        if pd.isna(want.loc[key]):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[key])


def test_ols(df, pdf):
    row = stats.ols(df).first()
    slope, intercept = np.polyfit(pdf.Risk_Score, pdf.Price, 1)
    assert (row.slope, row.intercept) == pytest.approx((slope, intercept))
    assert row.r2 == pytest.approx(pdf.Price.corr(pdf.Risk_Score) ** 2) and row.n == len(pdf)
    flat = stats.ols(df.selectExpr("Price", "1.0D as Risk_Score")).first()
    assert flat.slope is None


def test_ols_band(df, pdf):
    band = stats.ols_band(df, replicates=400, seed=2).orderBy("x").toPandas()
    again = stats.ols_band(df.repartition(3), replicates=400, seed=2).orderBy("x").toPandas()
    assert len(band) == 100 and np.allclose(band, again)
    assert band.x.iloc[0] == pdf.Risk_Score.min() and band.x.iloc[-1] == pytest.approx(pdf.Risk_Score.max())
    slope, intercept = np.polyfit(pdf.Risk_Score, pdf.Price, 1)
    fit = intercept + slope * band.x
    assert ((band.lo < fit) & (fit < band.hi)).all()
    rng, draws = np.random.default_rng(0), []
    for _ in range(400):
        pick = rng.integers(0, len(pdf), len(pdf))
        draws.append(np.polyval(np.polyfit(pdf.Risk_Score.values[pick], pdf.Price.values[pick], 1), band.x))
    lo, hi = np.percentile(draws, [2.5, 97.5], axis=0)
    assert (band.hi - band.lo).mean() == pytest.approx((hi - lo).mean(), rel=0.15)


@pytest.mark.parametrize("bins", [40, 1, 7])
def test_histogram(df, pdf, bins):
    got = stats.histogram(df, bins=bins).orderBy("bin").toPandas()
    counts, edges = np.histogram(pdf.Risk_Score, bins=bins)
    assert list(got.n) == list(counts) and got.n.sum() == len(pdf)
    assert np.allclose(got.lo, edges[:-1]) and np.allclose(got.hi, edges[1:])


def test_histogram_of_equal_values_and_gaps(spark):
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,), (float("nan"),)], "Risk_Score double")
    got = stats.histogram(flat, bins=4).orderBy("bin").toPandas()
    counts, edges = np.histogram([3.0, 3.0], bins=4)
    assert list(got.n) == list(counts) and np.allclose(got.lo, edges[:-1])
    assert stats.histogram(flat.where("false"), bins=4).agg({"n": "sum"}).first()[0] == 0


def test_density(df, pdf):
    got = stats.density(df).orderBy("x").toPandas()
    v = pdf.Risk_Score.values
    width = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - v) / width) ** 2).sum(axis=1) / (len(v) * width * np.sqrt(2 * np.pi))
    assert np.allclose(got.x, grid) and np.allclose(got.density, want)
    drawn = stats.density(df, bins=40).orderBy("x").toPandas()
    assert np.allclose(drawn.density, want * len(v) * (v.max() - v.min()) / 40)
    flat = stats.density(df.selectExpr("1.0D as Risk_Score")).collect()
    assert all(r.density is None for r in flat)


def test_box_stats(spark):
    rng = np.random.default_rng(8)
    data = {"a": np.append(rng.normal(50, 5, 999), [200.0, -90.0]).round(1), "b": np.array([1.0, 2.0, 30.0]), "c": np.array([5.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None), (None, 3.0)]
    got = {r.Period: r for r in stats.box_stats(spark.createDataFrame(rows, "Period string, Price double")).collect()}
    assert sorted(got) == ["a", "b", "c"]
    for key, vs in data.items():
        q1, med, q3 = np.percentile(vs, [25, 50, 75])
        inside = vs[(vs >= q1 - 1.5 * (q3 - q1)) & (vs <= q3 + 1.5 * (q3 - q1))]
        r = got[key]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert (r.whisker_lo, r.whisker_hi) == pytest.approx((min(inside.min(), q1), max(inside.max(), q3)))
        assert (r.n, r.outliers) == (len(vs), len(vs) - len(inside))


def test_summary_and_uplift(df, pdf):
    row = stats.summary(df).first()
    assert row.n_rows == len(pdf) and row.max_risk == pdf.Risk_Score.max() and row.max_price == pdf.Price.max()
    assert row.r == round(pdf.Risk_Score.corr(pdf.Price), 3)
    early = pdf[pdf.full_date.dt.year < 2024].Price.mean()
    got = stats.uplift(df).first()
    assert got.uplift_pct == pytest.approx((pdf.Price.max() / early - 1) * 100)
    assert stats.uplift(df, 1999).first().uplift_pct is None
