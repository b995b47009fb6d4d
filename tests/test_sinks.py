from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from data import PRICES
from swellmark import schemas
from swellmark.operators.cleaning import study_window
from swellmark.plans.batch import news_from_exports, refresh
from swellmark.sources import sinks, tables


def names(folder):
    return sorted(p.name for p in Path(folder).iterdir())


def news(spark, days):
    return spark.createDataFrame([(i, d, "YEM", -1.0, f"u{i}") for i, d in enumerate(days)], schemas.NEWS)


def test_news_is_partitioned_by_month_and_replaced(spark, tmp_path):
    target = str(tmp_path / "news")
    assert sinks.write_news(news(spark, ["20240101", "20240131", "20240201", "2023"]), target) == 4
    assert sinks.write_news(news(spark, ["20240101", "20240131", "20240201"]), target) == 3
    assert names(tmp_path) == ["news"]
    stored = spark.read.parquet(target)
    assert {r.event_month for r in stored.select("event_month").distinct().collect()} == {202401, 202402}
    kept = study_window(stored, "2024-01-15", "2024-01-31")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 1 and "PartitionFilters: [isnotnull(event_month" in plan
    assert tables.read_table(spark, target, schemas.NEWS).select(*schemas.NEWS.fieldNames()).count() == 3


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "news")
    sinks.write_news(news(spark, ["20240101"]), target)
    broken = news(spark, ["20240102"]).withColumn("Tone", F.raise_error(F.lit("broken input")).cast("double"))
    with pytest.raises(Exception, match="broken input"):
        sinks.write_news(broken, target)
    assert tables.read_table(spark, target, schemas.NEWS).first().Day == "20240101"


def test_empty_result_leaves_gold_untouched(spark, tmp_path):
    target = str(tmp_path / "gold")
    gold = spark.createDataFrame([(datetime(2024, 1, 1), 1.0, 2, 3.0)], schemas.GOLD)
    assert sinks.write_if_nonempty(gold.where("false"), target) == 0
    assert names(tmp_path) == []
    assert sinks.write_if_nonempty(gold, target) == 1
    assert sinks.write_if_nonempty(gold.where("false"), target) == 0
    assert names(tmp_path) == ["gold"]
    assert tables.read_gold(spark, target).collect() == gold.collect()


def test_gold_is_read_in_order(spark, tmp_path):
    target = str(tmp_path / "gold")
    gold = spark.createDataFrame([(datetime(2024, 1, 1, h), float(h), 1, 1.0) for h in (3, 1, 2)], schemas.GOLD)
    sinks.write_if_nonempty(gold.repartition(3), target)
    assert [r.Price for r in tables.read_gold(spark, target).collect()] == [1.0, 2.0, 3.0]
    assert tables.read_gold(spark, target, order=False).columns == schemas.GOLD.fieldNames()


def test_csv_round_trips(spark, tmp_path):
    articles = news(spark, ["20240101"]).withColumn("SourceURL", F.lit('a,"b"'))
    assert sinks.write_csv(articles, str(tmp_path / "n")) == 1
    assert tables.read_news_csv(spark, str(tmp_path / "n")).collect() == articles.collect()
    weekly = spark.createDataFrame(PRICES, "Date string, Route string, Price double")
    assert sinks.write_csv(weekly, str(tmp_path / "r")) == 17
    rates = tables.read_rates_csv(spark, str(tmp_path / "r"))
    assert rates.schema == schemas.RATES
    assert rates.agg(F.min("Date")).first()[0] == datetime(2023, 10, 19)


def test_csv_with_swapped_columns_is_refused(spark, tmp_path):
    weekly = spark.createDataFrame(PRICES, "Date string, Route string, Price double")
    sinks.write_csv(weekly.select("Route", "Date", "Price"), str(tmp_path / "r"))
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_rates_csv(spark, str(tmp_path / "r")).collect()


def test_tables_have_the_declared_columns(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert tables.read_table(spark, str(tmp_path / "empty"), schemas.NEWS).count() == 0
    spark.createDataFrame([("1", "20240101")], "GlobalEventID string, Day string").createOrReplaceTempView("part_news")
    got = tables.read_table(spark, "part_news", schemas.NEWS)
    assert got.schema == schemas.NEWS and got.first().GlobalEventID == 1 and got.first().Tone is None
    path = str(tmp_path / "orc")
    news(spark, ["20240101"]).write.orc(path)
    assert tables.read_table(spark, path, schemas.NEWS, fmt="orc").count() == 1


def test_jdbc_options():
    split = tables.jdbc_options("jdbc:x", "t", "id", 0, 100, 8, {"user": "u"})
    assert split == {
        "url": "jdbc:x", "dbtable": "t", "user": "u",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert tables.jdbc_options("jdbc:x", "t", None, None, None, 1) == {"url": "jdbc:x", "dbtable": "t"}
    wide = sinks.jdbc_write_options("jdbc:x", "t", "Price FLOAT", 500, {})
    assert wide == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500", "createTableColumnTypes": "Price FLOAT"}


def test_row_counts_come_with_the_action(spark):
    counted, seen = sinks.run_metrics(spark.range(7), "seven")
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


@pytest.fixture
def exports(tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    for day in range(19, 29):
        lines = [f"http://x/{i:03d},2023-10-{day}T0{i % 10}:00Z,-{i % 7}.5" for i in range(300)]
        (folder / f"{day}.csv").write_text("URL,Date,Tone\n" + "\n".join(lines) + "\n")
    (folder / "bad.csv").write_text("<html></html>")
    return str(folder)


@pytest.fixture
def weekly_csv(tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("Date,Route,Price\n" + "".join(f"{d},{r},{p:.0f}\n" for d, r, p in PRICES))
    return str(path)


def test_batch_job(spark, tmp_path, exports, weekly_csv):
    base = str(tmp_path / "store")
    Path(base).mkdir()
    counts = refresh(spark, exports, weekly_csv, base, noise_sd=0.0)
    assert counts == {"news": 3000, "rates": 2689, "gold": 240}
    assert refresh(spark, exports, weekly_csv, base, noise_sd=0.0) == counts
    assert names(base) == ["gold", "news", "rates"]
    gold = tables.read_gold(spark, f"{base}/gold")
    assert gold.agg(F.min("news_count"), F.max("news_count")).first() == (300, 300)
    stored = tables.read_table(spark, f"{base}/news", schemas.NEWS)
    assert stored.agg(F.min("GlobalEventID"), F.max("GlobalEventID")).first() == (100000, 102999)


def test_batch_job_without_new_matches_keeps_gold(spark, tmp_path, exports, weekly_csv):
    base = str(tmp_path / "store")
    Path(base).mkdir()
    refresh(spark, exports, weekly_csv, base)
    late = tmp_path / "late"
    late.mkdir()
    (late / "a.csv").write_text("URL,Date,Tone\nu,20300101,-1\n")
    assert refresh(spark, str(late), weekly_csv, base)["gold"] == 0
    assert tables.read_gold(spark, f"{base}/gold").count() == 240


def test_news_capped_only_on_demand(spark, exports):
    assert news_from_exports(spark, exports).count() == 3000
    assert news_from_exports(spark, exports, per_day=250).count() == 2500


def test_news_outside_the_rates_window_is_not_read(spark, tmp_path, exports, weekly_csv):
    from swellmark.operators.gold import build_gold

    base = str(tmp_path / "store")
    Path(base).mkdir()
    refresh(spark, exports, weekly_csv, base)
    stored = tables.read_table(spark, f"{base}/news", schemas.STORED_NEWS)
    assert stored.schema == schemas.STORED_NEWS
    rates = tables.read_table(spark, f"{base}/rates", schemas.RATES)
    plan = build_gold(rates, study_window(stored))._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan[plan.index("PartitionFilters: [isnotnull(event_month") :]


def test_shuffles_grow_with_the_input(spark, tmp_path, monkeypatch):
    from swellmark import session

    news(spark, [f"202401{d:02d}" for d in range(1, 29)] * 100).write.parquet(str(tmp_path / "n"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stored = tables.read_table(spark, str(tmp_path / "n"), schemas.NEWS)
    try:
        assert session.size_shuffles(stored) == int(before)
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
        assert session.size_shuffles(stored) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sized_shuffles_leave_the_setting_as_it_was(spark, tmp_path, monkeypatch):
    from swellmark import session

    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
    news(spark, [f"202401{d:02d}" for d in range(1, 29)] * 100).write.parquet(str(tmp_path / "n"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stored = tables.read_table(spark, str(tmp_path / "n"), schemas.NEWS)
    with session.sized_shuffles(stored) as wanted:
        assert wanted > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ValueError), session.sized_shuffles(stored):
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
