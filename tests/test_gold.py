from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from swellmark import schemas
from swellmark.operators import frames, gold, stats
from swellmark.operators.upsample import upsample_linear


def news(spark, rows):
    return spark.createDataFrame([(i, d, "YEM", t, f"u{i}") for i, (d, t) in enumerate(rows)], schemas.NEWS)


def hours(spark, first, n, route="r", price=1.0):
    return spark.sql(
        f"select timestamp_ntz'{first}' + make_interval(0,0,0,0,cast(id as int)) as Date, '{route}' as Route, "
        f"cast({price} as double) + id as Price from range({n})"
    )


def test_null_tone_counts_but_is_not_averaged(spark):
    row = gold.aggregate_news(news(spark, [("20240101", -2.0), ("20240101", None), ("20240101", -4.0)])).first()
    assert (row.event_date, row.news_count, row.avg_conflict_score) == (date(2024, 1, 1), 3, 3.0)


def test_bad_days_form_one_null_group_and_leave_at_the_join(spark):
    daily = gold.aggregate_news(news(spark, [("2023", -2.0), ("x", -2.0), ("20240101", 1.0)]))
    assert {(r.event_date, r.news_count) for r in daily.collect()} == {(None, 2), (date(2024, 1, 1), 1)}
    built = gold.build_gold(hours(spark, "2023-12-31 22:00:00", 4), news(spark, [("2023", -2.0), ("20240101", 1.0)]))
    assert sorted((r.full_date.hour, r.news_count, r.avg_conflict_score) for r in built.collect()) == [
        (0, 1, -1.0),
        (1, 1, -1.0),
    ]
    assert built.columns == schemas.GOLD.fieldNames()


def test_week_grain_starts_on_monday(spark):
    weekly = gold.aggregate_news(news(spark, [("20240107", -1.0), ("20240108", -1.0), ("20240114", -3.0)]), "week")
    got = {r.event_date: (r.news_count, r.avg_conflict_score) for r in weekly.collect()}
    assert got == {date(2024, 1, 1): (1, 1.0), date(2024, 1, 8): (2, 2.0)}
    with pytest.raises(ValueError):
        gold.aggregate_news(news(spark, []), "hour")


def test_routes_are_kept_on_request(spark):
    rates = hours(spark, "2024-01-01 00:00:00", 2, "a").union(hours(spark, "2024-01-01 00:00:00", 2, "b"))
    built = gold.build_gold(rates, news(spark, [("20240101", -2.0)]), keep_route=True)
    assert built.columns == schemas.GOLD_BY_ROUTE.fieldNames()
    assert sorted(r.Route for r in built.collect()) == ["a", "a", "b", "b"]


def test_hourly_fan_out_of_event_counts(spark):
    rates = hours(spark, "2024-01-01 00:00:00", 24)
    frame = frames.risk_score(gold.build_gold(rates, news(spark, [("20240101", -2.0)] * 5)))
    assert stats.total_events(frame).first()[0] == 120
    assert stats.total_events(frame, distinct_days=True).first()[0] == 5
    assert stats.kpis(frame).first().total_events == 120


def test_distinct_days_sum_to_the_articles_inside_the_rates_window(spark, weekly):
    articles = news(spark, [("20231019", -1.0)] * 3 + [("20231231", -1.0)] * 4 + [("20250101", -1.0), ("bad", -1.0)])
    built = gold.build_gold(upsample_linear(weekly), articles)
    assert stats.total_events(built, distinct_days=True).first()[0] == 7


def test_risk_score_multiplies_before_rounding(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 10.005, 3, 1.116)], schemas.GOLD)
    row = frames.risk_score(df).first()
    assert (row.Risk_Score, row.avg_conflict_score) == (3.35, 1.12)
    assert frames.risk_score(df, round_score=False).first().avg_conflict_score == 1.116


def test_join_plan_has_one_shuffle_for_news_and_none_for_prices(spark):
    rates = spark.createDataFrame([], schemas.RATES)
    plan = gold.build_gold(rates, news(spark, [("20240101", -1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 1


def test_frame_filters_and_views(spark):
    frame = frames.risk_score(
        gold.build_gold(hours(spark, "2023-11-10 00:00:00", 24 * 10), news(spark, [(f"202311{d}", -1.5) for d in range(10, 20)]))
    )
    window = frames.default_window(frame)
    assert window.agg(F.min("full_date"), F.max("full_date")).first() == (
        datetime(2023, 11, 15), datetime(2023, 11, 19, 23),
    )
    assert frames.default_window(frame, "2023-01-01", "2023-11-11").count() == 48
    assert frames.default_bounds(frame).first() == (date(2023, 11, 15), date(2023, 11, 19))
    assert frames.default_bounds(frame, "2023-01-01", "2023-11-11").first() == (date(2023, 11, 10), date(2023, 11, 11))
    assert frames.default_window(frame, "2030-01-01", "2031-01-01").count() == 0
    assert frames.filter_dates(frame, "2023-11-12", "2023-11-13").count() == 48
    assert frames.filter_instants(frame, "2023-11-12", "2023-11-13").count() == 25
    assert frames.filter_instants(frame, datetime(2023, 11, 12, 5), datetime(2023, 11, 12, 7)).count() == 3
    assert [r.full_date.hour for r in frames.head(frame).collect()] == [0, 1, 2, 3, 4]
    assert frames.raw_table(frame, 1).first().full_date == datetime(2023, 11, 19, 23)
    assert frames.raw_table(frame).count() == 240
    assert frames.trend(frame).columns == ["full_date", "Risk_Score", "Price"]
    assert frames.panic_meter(frame).columns == ["full_date", "avg_conflict_score", "news_count", "Price"]
    assert frames.risk_line(frame).columns == ["full_date", "Risk_Score"]
    assert tuple(frames.bounds(frame).first()) == (datetime(2023, 11, 10), datetime(2023, 11, 19, 23))


def test_date_window_is_pushed_into_the_scan(spark, tmp_path):
    frame = frames.risk_score(gold.build_gold(hours(spark, "2024-01-01 00:00:00", 48), news(spark, [("20240101", -1.0)])))
    frame.write.parquet(str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g"))
    plan = frames.trend(frames.filter_dates(stored, "2024-01-01", "2024-01-02"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(full_date" in plan and "LessThan(full_date" in plan
    assert "ReadSchema: struct<full_date:timestamp_ntz,Price:double,Risk_Score:double>" in plan


def test_period_labels(spark):
    df = spark.createDataFrame([(datetime(2023, 12, 31, 23),), (datetime(2024, 1, 1),)], "full_date timestamp_ntz")
    assert [r.Period for r in frames.with_period(df).orderBy("full_date").collect()] == ["Baseline (2023)", "Crisis (2024)"]


def test_dates_are_parsed_after_the_aggregation(spark, tmp_path):
    news(spark, [("20240101", -1.0)]).write.parquet(str(tmp_path / "n"))
    stored = spark.read.schema(schemas.NEWS).parquet(str(tmp_path / "n"))
    plan = gold.build_gold(spark.createDataFrame([], schemas.RATES), stored)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_count") :]
    assert "gettimestamp" in plan and "gettimestamp" not in below
    assert "ReadSchema: struct<Day:string,Tone:double>" in plan
