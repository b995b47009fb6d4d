"""Phrase tables, footers, commit log, snapshots, one-pass exports, ingestion, restated days."""

import pytest
from pyspark.sql import functions as F

from swellmark import schemas
from swellmark.operators import cleaning, phrases
from swellmark.operators.tone import WORD_BREAK, with_lexicon_tone
from swellmark.session import scratch_path
from swellmark.sources.commits import CommitLog, IdLedger, Taken
from swellmark.sources.exports import csv_fields, read_exports_by_line, read_raw_exports
from swellmark.sources.footers import footer_bounds, reads_footers_only
from swellmark.sources.snapshots import SnapshotTable
from swellmark.streaming.ingest import ExportStore, export_stream, stream_exports
from swellmark.streaming.restate import add_articles, late_table, restated_days

# --------------------------------------------------------------------------- phrases

TEXTS = [
    (1, "The Red Sea, and the red-sea route."),
    (2, "redsea red  sea"),
    (3, "Bab-el-Mandeb: red sea red sea red sea"),
    (4, "a #tag and a#tag and #tags"),
    (5, None),
    (6, ""),
    (7, "Ünï cödé café. ÜNÏ CÖDÉ"),
    (8, "C++ or c++11 or (c++)"),
    (1, "red sea again"),
]

PHRASES = ["red sea", "Red-Sea", "bab-el-mandeb", "#tag", "ünï cödé", "c++", "sea", "the", "not there", "red sea red", "", None, "red sea"]


def test_phrases_agree_with_one_pattern_each(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id int, text string")
    table = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    got = {(r.doc_id, r.phrase): r.n for r in phrases.find_phrases(docs, table).collect()}
    want = {}
    for p in {p.lower() for p in PHRASES if p}:
        for r in cleaning.match_news(docs, "text", [p], max_tone=None).collect():
            want[(r.doc_id, p)] = True
    assert set(got) == set(want)
    assert got[(3, "red sea")] == 3 and got[(3, "red sea red")] == 2 and got[(1, "red sea")] == 2
    matched = phrases.match_phrases(docs.dropDuplicates(["doc_id"]), table).select("doc_id").collect()
    assert {r.doc_id for r in matched} <= {d for d, _ in want}


def test_phrases_without_texts_or_phrases(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id int, text string")
    none = spark.createDataFrame([], "phrase string")
    some = spark.createDataFrame([("red sea",)], "phrase string")
    assert phrases.find_phrases(docs, none).columns == ["doc_id", "phrase", "n"]
    assert phrases.find_phrases(docs, none).count() == 0
    assert phrases.find_phrases(docs.limit(0), some).count() == 0
    assert phrases.match_phrases(docs.withColumn("Tone", F.lit(1.0)), some, max_tone=0.5).count() == 0


def test_phrases_are_filed_under_rare_words(spark):
    docs = spark.createDataFrame([(1, "the cat the dog"), (2, "the dog"), (3, "the the")], "doc_id int, text string")
    table = spark.createDataFrame([("the dog the cat",), ("the",)], "phrase string")
    index = {r.phrase: r for r in phrases.phrase_index(table, docs).collect()}
    assert (index["the dog the cat"].at, index["the dog the cat"].size) == (5, 3)  # ends with the rarest word
    assert (index["the"].at, index["the"].size) == (1, 1)


def test_a_long_list_of_phrases_stays_a_join(spark):
    table = spark.range(20_000).selectExpr("concat('word', id, ' tail') as phrase")
    docs = spark.range(400).selectExpr("id as doc_id", "concat('so word', id * 7, ' tail ends') as text")
    assert phrases.find_phrases(docs, table).count() == 400


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_of_texts_stay_in_place_for_a_list_that_fits(spark, monkeypatch):
    docs = spark.createDataFrame([*TEXTS, (None, "Red sea")], "doc_id int, text string")
    table = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = phrases.find_phrases(docs, table)
        assert "hashpartitioning(run" not in _plan(placed)
        got = {tuple(r) for r in placed.collect()}
        monkeypatch.setattr(phrases, "INDEX_BYTES", 0)
        shuffled = phrases.find_phrases(docs, table)
        assert "hashpartitioning(run" in _plan(shuffled)
        assert got == {tuple(r) for r in shuffled.collect()} and (None, "red sea", 1) in got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_tone_is_judged_once(spark):
    path = scratch_path(spark, "test-tone")
    spark.createDataFrame(TEXTS, "doc_id int, text string").dropDuplicates(["doc_id"]).write.parquet(path)
    docs = with_lexicon_tone(spark.read.parquet(path), ["tag"], ["sea"])
    assert docs.where("Tone < 0")._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2  # filter, column
    table = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    matched = phrases.match_phrases(docs, table, max_tone=0.0)
    assert WORD_BREAK not in _plan(matched)  # later passes read the texts that were kept
    want = {r.doc_id for r in docs.where("Tone < 0").collect()}
    assert want and {r.doc_id for r in matched.collect()} == want & {r.doc_id for r in phrases.find_phrases(docs, table).collect()}


# --------------------------------------------------------------------------- footers


def test_footer_bounds_read_no_rows(spark):
    path = scratch_path(spark, "test-footer")
    rows = spark.range(1000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 60 as int)) as day", "id % 3 as part", "timestamp_ntz'2024-01-01 00:00:00' as ts")
    rows.write.partitionBy("part").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = footer_bounds(spark, path, ["id", "day"])
    assert reads_footers_only(found) and not reads_footers_only(spark.read.parquet(path).agg(F.min("id")))
    (row,) = found.collect()
    assert (row.min_id, row.max_id, str(row.min_day), str(row.max_day), row.n) == (0, 999, "2024-01-01", "2024-02-29", 1000)
    months = footer_bounds(spark, path, ["id"], by=["part"])
    assert reads_footers_only(months) and {tuple(r) for r in months.collect()} == {(0, 0, 999, 334), (1, 1, 997, 333), (2, 2, 998, 333)}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    with pytest.raises(TypeError):
        footer_bounds(spark, path, ["ts"])
    empty = scratch_path(spark, "test-footer")
    rows.drop("part").limit(0).write.parquet(empty)
    assert tuple(footer_bounds(spark, empty, ["id"], rows.drop("part").schema).first()) == (None, None, None)


# --------------------------------------------------------------------------- log and ids


def test_an_entry_is_written_once(spark):
    log = CommitLog(spark, scratch_path(spark, "test-log"))
    assert log.numbers() == [] and log.latest() is None and log.find("batch", "a") is None
    log.commit(1, {"batch": "a", "x": 1})
    with pytest.raises(Taken):
        log.commit(1, {"batch": "b", "x": 2})
    log.commit(2, {"batch": "a", "x": 3})
    assert log.numbers() == [1, 2] and log.read(1)["x"] == 1 and log.latest()["x"] == 3
    assert log.find("batch", "a")["x"] == 1 and log.find("batch", "b") is None


def test_ids_carry_on_and_are_granted_once(spark):
    folder = scratch_path(spark, "test-ids")
    ledger = IdLedger(spark, folder, 100)
    assert [ledger.grant("a", 5), ledger.grant("b", 0), ledger.grant("c", 2)] == [100, 105, 105]
    assert IdLedger(spark, folder, 1).grant("a", 5) == 100 and ledger.grant("d", 1) == 107
    with pytest.raises(ValueError):
        ledger.grant("a", 6)


def test_a_writer_that_is_overtaken_looks_again(spark):
    folder = scratch_path(spark, "test-ids")
    one, two = IdLedger(spark, folder, 0), IdLedger(spark, folder, 0)
    commit, calls = one.log.commit, []

    def overtaken(number, entry):
        if not calls:
            calls.append(two.grant("other", 3))
        commit(number, entry)

    one.log.commit = overtaken
    assert one.grant("mine", 2) == 3 and two.grant("mine", 2) == 3


# --------------------------------------------------------------------------- snapshots

SCHEMA = "id long, part string"


def _table(spark, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return SnapshotTable(spark, scratch_path(spark, "test-snapshot"), schema, **options)


def _ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_versions_of_a_table(spark, partition_by):
    table = _table(spark, partition_by=partition_by)
    rows = spark.range(6).selectExpr("id", "cast(id % 2 as string) as part")
    assert table.version() == 0 and table.read().count() == 0 and table.history().count() == 0
    assert table.replace(rows.where("id < 2")) == 2
    reader = table.read()
    assert table.append(rows.where("id >= 2")) == 4
    assert _ids(reader) == [0, 1]  # a reader keeps the version it began with
    assert _ids(table.read()) == list(range(6)) and _ids(table.read(1)) == [0, 1]
    assert table.replace(rows.limit(0), skip_empty=True) == 0 and table.version() == 2
    assert table.replace(rows.where("id = 5")) == 1 and _ids(table.read()) == [5] and _ids(table.read(2)) == list(range(6))
    assert table.replace(rows.limit(0)) == 0 and table.read().count() == 0
    operations = [tuple(r) for r in table.history().select("operation", "rows", "total_rows").collect()]
    assert operations == [("replace", 2, 2), ("append", 4, 6), ("replace", 1, 1), ("replace", 0, 0)]


def test_a_named_batch_is_written_once(spark):
    table = _table(spark)
    rows = spark.range(3).selectExpr("id", "'x' as part")
    assert [table.append(rows, "b1"), table.append(rows.limit(1), "b1"), table.append(rows, "b2")] == [3, 3, 3]
    assert table.version() == 2 and table.read().count() == 6


def test_a_failed_write_leaves_the_table_and_no_folder(spark):
    table = _table(spark)
    table.replace(spark.range(2).selectExpr("id", "'x' as part"))
    bad = spark.range(4).selectExpr("if(id = 3, cast(raise_error('no') as bigint), id) as id", "'x' as part")
    with pytest.raises(Exception, match="no"):
        table.replace(bad)
    assert _ids(table.read()) == [0, 1] and table.version() == 1 and table.clean(min_age=0) == []


def test_cleaning_and_compaction(spark):
    table = _table(spark)
    for i in range(3):
        table.append(spark.range(i, i + 1).selectExpr("id", "'x' as part"))
    assert table.compact() == 3 and _ids(table.read()) == [0, 1, 2]
    assert table.clean(keep=2, min_age=0) == [] and _ids(table.read(3)) == [0, 1, 2]
    assert table.clean(min_age=3600) == []
    assert len(table.clean(min_age=0)) == 3 and _ids(table.read()) == [0, 1, 2]


def test_appends_of_two_writers_are_both_kept(spark):
    table = _table(spark)
    other = SnapshotTable(spark, table.base, table.schema)
    commit, calls = table.log.commit, []

    def overtaken(number, entry):
        if not calls:
            calls.append(other.append(spark.range(5, 6).selectExpr("id", "'y' as part")))
        commit(number, entry)

    table.log.commit = overtaken
    table.append(spark.range(1).selectExpr("id", "'x' as part"))
    assert _ids(table.read()) == [0, 5] and table.version() == 2


# --------------------------------------------------------------------------- exports


def _files(spark, texts):
    base = scratch_path(spark, "test-exports")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name, text in texts.items():
        path = fs.Path(f"{base}/{name}")
        stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        stream.write(text.encode())
        stream.close()
    return base


FILES = {
    "a.csv": "﻿URL,Date,Tone\n  u1 ,2024-01-02,-1.5\n\"u,2\",20240103,\n\"say \"\"hi\"\"\",2024-01-04T05:00Z,2\n",
    "b b.csv": "\n\ndate,url,AvgTone,extra\n20240105,u5,3,x,more\n20240106\n,u7,1\n",
    "c.csv": "Date,Date,url\n20240101,20240109,u9\n",
    "page.html": "<html>\n<p>Date</p>\n</html>\n",
    "empty.csv": "",
    "blank.csv": "\n  \n",
    "only.csv": "Date,URL\n",
}


def test_lines_are_read_by_their_own_header(spark):
    base = _files(spark, FILES)
    one = read_raw_exports(spark, f"{base}/*")
    two = read_exports_by_line(spark, f"{base}/*")
    got = sorted(map(str, two.drop("file_path").collect()))
    assert got == sorted(map(str, one.drop("file_path").collect())) and len(got) == 7
    assert {r.file_path.rsplit("/", 1)[1] for r in two.collect()} == {"a.csv", "b%20b.csv", "c.csv"}
    strict = read_exports_by_line(spark, f"{base}/*", strict_sniff=True)
    assert strict.count() == read_raw_exports(spark, f"{base}/*", strict_sniff=True).count()


def test_many_headers_make_one_plan(spark):
    base = _files(spark, {f"{i}.csv": f"{'x,' * i}Date,url\n{'1,' * i}2024010{i},u{i}\n" for i in range(1, 9)})
    raw = read_exports_by_line(spark, base)
    plan = raw._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("FileScan text") == 2  # one for headers, one for lines
    assert sorted((r.raw_date, r.raw_url) for r in raw.collect()) == [(f"2024010{i}", f"u{i}") for i in range(1, 9)]


def test_fields_of_a_line(spark):
    lines = ['a,b', '"a,b",c', '"x ""y"" z",', ',', '"open', 'plain "q" in', "x" * 20_000, '"' + "y" * 20_000 + '",1', '""']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, v string")
    got = {r.i: r.f for r in df.select("i", csv_fields("v").alias("f")).collect()}
    assert got[0][:2] == ["a", "b"] and got[1][:2] == ["a,b", "c"] and got[2][:2] == ['x "y" z', ""] and got[3][:2] == ["", ""]
    assert got[5][0] == 'plain "q" in' and len(got[6][0]) == 20_000 and got[7][:2] == ["y" * 20_000, "1"] and got[8][0] == ""


def test_ingestion_that_stops_half_way_is_run_again(spark, monkeypatch):
    base = _files(spark, {f"in/{k}": v for k, v in FILES.items()})
    read = lambda: export_stream(spark, f"{base}/in")
    append, seen = SnapshotTable.append, []

    def failing(self, df, batch=None):
        if self.base.endswith("/news") and not seen:
            seen.append(batch)
            raise RuntimeError("lost")
        return append(self, df, batch)

    monkeypatch.setattr(SnapshotTable, "append", failing)
    heard = []
    run = dict(base=f"{base}/store", checkpoint=f"{base}/checkpoint", start=10, on_batch=lambda b, n: heard.append((b, n)))
    with pytest.raises(Exception, match="lost"):
        stream_exports(read(), **run).awaitTermination()
    stream_exports(read(), **run).awaitTermination()
    store = ExportStore(spark, f"{base}/store", 10)
    assert heard == [("stream-0", 5)]
    assert sorted(r.GlobalEventID for r in store.news.read().collect()) == list(range(10, 15))
    assert sorted(r.reject_reason for r in store.rejects.read().collect()) == ["date", "url"]
    assert store.news.version() == store.rejects.version() == store.files.version() == 1
    # A file that comes later gets the ids behind.
    spark.createDataFrame([("20240201", "late")], "Date string, url string").coalesce(1).write.csv(f"{base}/more", header=True)
    store.add(spark.read.text(f"{base}/more").selectExpr("value", "_metadata.file_path as file_path", "true as opening"), "by hand")
    assert store.news.read().agg(F.max("GlobalEventID")).first()[0] == 15
    done = {r.file_path.rsplit("/", 1)[1]: (r.n_lines, r.is_data) for r in store.files.read().where("batch = 'stream-0'").collect()}
    assert done == {"a.csv": (3, True), "b%20b.csv": (3, True), "c.csv": (1, True), "only.csv": (0, True), "page.html": (2, False)}
    assert store.news.schema == schemas.NEWS


# --------------------------------------------------------------------------- restated days


def test_late_articles_restate_their_day(spark):
    base = scratch_path(spark, "test-late")

    def batch(name, rows):
        df = spark.createDataFrame(rows, "day string, Tone double, id int").selectExpr("cast(day as timestamp_ntz) as ts", "Tone", "id")
        return add_articles(df, base, name), df.schema

    batch("a", [("2024-01-01 10:00:00", -2.0, 1), ("2024-01-05 00:00:00", None, 2), (None, 1.0, 3)])
    batch("b", [("2024-01-02 23:59:59", -4.0, 4), ("2024-01-03 00:00:00", -1.0, 5), ("2024-01-01 11:00:00", -6.0, 6)])
    (_, late), schema = batch("b", [("2024-01-02 23:59:59", -4.0, 4)])  # again: nothing changes
    assert late == 2
    got = {str(r.event_date): tuple(r)[1:] for r in restated_days(spark, base).collect()}
    assert got == {
        "2024-01-01": (2, 4.0, 1),
        "2024-01-02": (1, 4.0, 1),
        "2024-01-03": (1, 1.0, 0),
        "2024-01-05": (1, None, 0),
    }
    first = {str(r.event_date): r.news_count for r in restated_days(spark, base, with_late=False).collect()}
    assert first == {"2024-01-01": 1, "2024-01-03": 1, "2024-01-05": 1}
    assert sorted(r.id for r in late_table(spark, base, schema).read().collect()) == [4, 6]
