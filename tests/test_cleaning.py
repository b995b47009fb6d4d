import math

import pytest
from pyspark.sql import functions as F

from swellmark.operators import cleaning
from swellmark.sources.exports import data_files, read_raw_exports


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name.replace('__', ' ')}.csv").write_bytes(text.encode("utf-8"))
        return str(tmp_path)

    return write


def cleaned(spark, path, **options):
    return sorted(
        (r.Day, r.SourceURL, r.Tone) for r in cleaning.clean_news(read_raw_exports(spark, path), **options).collect()
    )


def test_headers_lose_marks_and_blanks(spark):
    df = spark.createDataFrame([("u", "d", "t")], "`\ufeffURL` string, ` Date ` string, Tone string")
    assert cleaning.normalize_headers(df).columns == ["URL", "Date", "Tone"]
    assert cleaning.clean_news(df.withColumn(" Date ", F.lit("2023-10-19"))).first().Day == "20231019"


def test_bom_header_and_date_spellings(spark, folder):
    path = folder(
        a="\ufeffURL,Date,Tone\r\nhttp://a,2023-10-19T05:00Z,-3.5\r\nhttp://b,20231019, -3.5 \r\n"
        "http://c,2023,\r\nhttp://d,abc,-1\r\nhttp://e,,-1\r\n"
    )
    assert cleaned(spark, path) == [
        ("2023", "http://c", None),
        ("20231019", "http://a", -3.5),
        ("20231019", "http://b", -3.5),
    ]


def test_headers_of_different_files_do_not_swap(spark, folder):
    path = folder(
        a="URL,Date,Tone\nu1,20240101,-1\n",
        b="date,url\n20240102,u2\n",
        c="Tone,URL,Date\n-3,u3,20240103\n",
        d="DATE,Url,AvgTone\n20240104,u4,-4\n",
        with__blank="Url,AvgTone,date\nu5,-5,20240105\n",
    )
    assert cleaned(spark, path) == [
        ("20240101", "u1", -1.0),
        ("20240102", "u2", None),
        ("20240103", "u3", -3.0),
        ("20240104", "u4", -4.0),
        ("20240105", "u5", -5.0),
    ]


def test_both_spellings_in_one_file_first_non_empty_wins(spark, folder):
    path = folder(a="date,Date,URL,url,tone,AvgTone\n20240101,20240102,u1,v1,-1,-2\n20240103,,,v2,,-2\n")
    assert cleaned(spark, path) == [("20240102", "u1", -1.0), ("20240103", "v2", -2.0)]


def test_quoted_fields_and_short_rows(spark, folder):
    path = folder(a='URL,Date,Tone\n"http://x/a,b",20240101,"-1.5"\n"say ""hi""",20240102\n\n   \n')
    assert cleaned(spark, path) == [("20240101", "http://x/a,b", -1.5), ("20240102", 'say "hi"', None)]


def test_files_that_are_no_data(spark, folder):
    path = folder(
        html="<html>\n<body>Date</body>\n</html>\n",
        empty="",
        blank="\n\n",
        ok="\n\nURL,Date,Tone\nu,20240101,-1\n",
        lower="date,url\n20240102,v\n",
    )
    report = {r.file_path.rsplit("/", 1)[1]: (r.is_data, r.n_lines) for r in data_files(spark, path).collect()}
    assert report == {"html.csv": (False, 3), "ok.csv": (True, 2), "lower.csv": (True, 2)}
    assert cleaned(spark, path) == [("20240101", "u", -1.0), ("20240102", "v", None)]
    strict = cleaning.clean_news(read_raw_exports(spark, path, strict_sniff=True))
    assert [r.SourceURL for r in strict.collect()] == ["u"]


def test_no_data_at_all_keeps_the_columns(spark, folder):
    raw = read_raw_exports(spark, folder(html="<html></html>\n"))
    assert cleaning.clean_news(raw).columns == ["Day", "Country", "Tone", "SourceURL"]
    assert raw.count() == 0


def test_large_file_is_read_in_splits(spark, folder):
    body = "".join(f"http://x/{i},20240101,-{i}\n" for i in range(3000))
    path = folder(big="URL,Date,Tone\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw_exports(spark, path)
        assert raw.rdd.getNumPartitions() > 2
        assert data_files(spark, path).first().header == "URL,Date,Tone"
        assert cleaning.clean_news(raw).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


RAW = [("20240101", "u", "-1"), ("20240101", "v", "x"), ("20240101", "  ", "-1"), ("abc", "w", "-1"), ("20240102", None, "-1")]


def test_rejects_carry_a_reason(spark):
    raw = spark.createDataFrame(RAW, "Date string, URL string, Tone string")
    news, rejects = cleaning.clean_news(raw, keep_rejects=True)
    assert sorted(r.SourceURL for r in news.collect()) == ["u", "v"]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["date", "url", "url"]
    news, rejects = cleaning.clean_news(raw, keep_rejects=True, tone_policy="drop")
    assert [r.SourceURL for r in news.collect()] == ["u"]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["date", "tone", "url", "url"]


def test_tone_fallback_draw(spark):
    raw = spark.createDataFrame(
        [("20240101", f"u{i}", None) for i in range(4000)], "Date string, URL string, Tone string"
    )
    tones = [r.Tone for r in cleaning.clean_news(raw, tone_policy="hash_normal", seed=1).collect()]
    assert sum(tones) / len(tones) == pytest.approx(-5.0, abs=0.15)
    assert not any(math.isnan(t) for t in tones) and len(set(tones)) == 4000
    with pytest.raises(ValueError):
        cleaning.clean_news(raw, tone_policy="guess")


def test_undated_rows_are_counted(spark):
    news = spark.createDataFrame([("20240101",), ("2023",), ("20241399",)], "Day string")
    assert tuple(cleaning.undated(news).first()) == (3, 2)


def test_match_news(spark):
    df = spark.createDataFrame(
        [
            (1, "A storm at sea.", -3.0),
            (2, "Stormy weather", -3.0),
            (3, "the north   port", -3.0),
            (4, "The North Port closes", -3.0),
            (5, "storm", -2.0),
            (6, None, -9.0),
            (7, "(storm)", None),
        ],
        "id int, text string, Tone double",
    )
    got = cleaning.match_news(df, "text", ["storm", "north port"])
    assert sorted(r.id for r in got.collect()) == [1, 4]
    loose = cleaning.match_news(df, "text", ["Storm"], max_tone=None)
    assert sorted(r.id for r in loose.collect()) == [1, 5, 7]
    signs = spark.createDataFrame([(1, "at Bab-el-Mandeb.", -9.0), (2, "bab el mandeb", -9.0), (3, "a", -9.0)], df.schema)
    assert [r.id for r in cleaning.match_news(signs, "text", ["bab-el-mandeb", "a|b", "d.e"]).collect()] == [1]


def test_study_window_is_inclusive(spark):
    days = spark.sql("select explode(sequence(date'2023-10-01', date'2024-03-01')) as event_date")
    kept = cleaning.study_window(days)
    assert kept.agg(F.min("event_date"), F.max("event_date"), F.count("*")).first()[2] == 113
    months = days.withColumn("event_month", cleaning.month_number(F.col("event_date")))
    assert cleaning.study_window(months).count() == 113


def test_all_kinds_of_blanks_are_trimmed(spark):
    raw = spark.createDataFrame(
        [("20240101", "\t u \xa0\n", "\t-2\r"), ("20240101", "\t\n", "-1")], "Date string, URL string, Tone string"
    )
    assert [(r.SourceURL, r.Tone) for r in cleaning.clean_news(raw).collect()] == [("u", -2.0)]
