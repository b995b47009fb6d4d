import pytest

import __spark_entry__ as contract
from conftest import SF, SF_SMALL
from oracle import compare
from swellmark.plans import catalog_state

QUERIES, SQL = catalog_state.QUERIES, catalog_state.ORACLE

#: Checked on the larger tables too.
WIDE = ["gold", "kpi_dates", "box_stats", "lag_scan", "ingest_exports", "lexicon_tone", "stream_daily", "radix_quantiles", "radix_box_stats", "fast_density", "stream_ingest", "late_days"]


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["full_date", "Price", "news_count", "avg_conflict_score", "Risk_Score"]
    assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    assert compare(spark, SF_SMALL, name, QUERIES, SQL) is None


@pytest.mark.parametrize("name", WIDE)
def test_agrees_with_sql_on_more_rows(spark, name):
    assert compare(spark, SF, name, QUERIES, SQL) is None


def test_ols_band_encloses_the_fit(spark):
    band = QUERIES["ols_band"](spark, SF_SMALL).toPandas()
    assert len(band) == 100 and (band.lo <= band.hi).all()


def test_noise_moves_prices_by_its_deviation(spark):
    pairs = QUERIES["noisy_rates"](spark, SF_SMALL).join(
        QUERIES["hourly_rates_multi"](spark, SF_SMALL).withColumnRenamed("Price", "clean"), ["Date", "Route"]
    )
    row = pairs.selectExpr("count(*) as n", "stddev(Price - clean) as sd", "avg(Price - clean) as mean").first()
    assert row.n == QUERIES["hourly_rates_multi"](spark, SF_SMALL).count()
    assert abs(row.sd - 5.0) < 0.05 and abs(row.mean) < 0.05
