"""Registered queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swellmark import fixed, schemas
from swellmark.operators import cleaning, frames, gold, ordering, series, stats, upsample
from swellmark.operators.tone import lexicon_tone, with_lexicon_tone
from swellmark.plans import adapters as data
from swellmark.plans.batch import news_from_exports
from swellmark.session import scratch_path
from swellmark.sources.exports import data_files, read_raw_exports
from swellmark.sources.sinks import write_csv, write_if_nonempty, write_news, write_rates
from swellmark.sources.tables import read_gold, read_news_csv, read_rates_csv, read_table
from swellmark.streaming.daily import stream_daily, stream_daily_dedup, stream_gold

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLE[name or fn.__name__] = sql
        return fn

    return register


def _r(c: str, digits: int = 6):
    """Sums of doubles depend on their order: compare them rounded."""
    return F.round(c, digits).alias(c)


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.select(*[_r(c, digits) if c in cols else F.col(c) for c in df.columns])


def _text(c: str):
    """Dates are compared as text: clients of the two engines hand out different date types."""
    return F.col(c).cast("string").alias(c)


def _dates_as_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[_text(c) if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------- SQL building blocks

SHORT_NEWS = """
news AS (
  SELECT event_id + 100000 AS GlobalEventID, strftime(ts, '%Y%m%d') AS day_s, 'YEM' AS Country,
         -value / pi() AS Tone, event_type || '/' || CAST(user_id AS VARCHAR) AS SourceURL
  FROM events)"""

SHORT_WEEKLY = """
weekly AS (
  SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS "Date", 'all' AS Route, avg(value * pi()) AS Price
  FROM events GROUP BY 1, 2)"""

LONG_NEWS = """
news AS (
  SELECT l_orderkey AS GlobalEventID, strftime(l_shipdate, '%Y%m%d') AS day_s, -l_quantity / pi() AS Tone
  FROM lineitem)"""

LONG_WEEKLY = """
weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS "Date", o_orderpriority AS Route,
         avg(o_totalprice * pi()) AS Price
  FROM orders GROUP BY 1, 2)"""

DAILY = """
daily AS (
  SELECT CAST(try_strptime(day_s, '%Y%m%d') AS DATE) AS event_date, count(*) AS news_count,
         avg(-Tone) AS avg_conflict_score
  FROM news GROUP BY 1)"""

HOURLY = """
anchors AS (
  SELECT Route, "Date", Price,
         lead("Date") OVER (PARTITION BY Route ORDER BY "Date") AS next_date,
         lead(Price) OVER (PARTITION BY Route ORDER BY "Date") AS next_price
  FROM weekly),
steps AS (
  SELECT *, unnest(range(0, date_diff('hour', "Date", coalesce(next_date, "Date" + INTERVAL 1 HOUR)))) AS i
  FROM anchors),
hourly AS (
  SELECT "Date" + to_hours(i) AS "Date", Route,
         CASE WHEN next_date IS NULL THEN Price
              ELSE Price + (next_price - Price) * i / date_diff('hour', "Date", next_date) END AS Price
  FROM steps)"""

GOLD = """
gold AS (
  SELECT h."Date" AS full_date, h.Price, d.news_count, d.avg_conflict_score, h.Route
  FROM hourly h JOIN daily d ON CAST(h."Date" AS DATE) = d.event_date)"""

FRAME = """
frame AS (
  SELECT full_date, round(Price, 2) AS Price, news_count, round(avg_conflict_score, 2) AS avg_conflict_score,
         Route, round(news_count * avg_conflict_score, 2) AS Risk_Score
  FROM gold)"""

TO_DAILY = """
per_day AS (
  SELECT Route, CAST(full_date AS DATE) AS day, avg(Price) AS avg_price, arg_max(Price, full_date) AS close_price,
         max(news_count) AS news_count, max(avg_conflict_score) AS avg_conflict_score,
         max(news_count) * max(avg_conflict_score) AS Risk_Score
  FROM frame GROUP BY 1, 2)"""

RETURNS = """
returns AS (
  SELECT Route, day, close_price,
         close_price / lag(close_price) OVER (PARTITION BY Route ORDER BY day) - 1 AS daily_return
  FROM per_day)"""


def _with(*blocks: str) -> str:
    return "WITH " + ",".join(blocks) + "\n"


SHORT = _with(SHORT_NEWS, SHORT_WEEKLY, DAILY, HOURLY, GOLD, FRAME)
LONG = _with(LONG_NEWS, LONG_WEEKLY, DAILY, HOURLY, GOLD, FRAME)
LONG_DAILY = _with(LONG_NEWS, LONG_WEEKLY, DAILY, HOURLY, GOLD, FRAME, TO_DAILY)


def _corr(x: str, y: str, digits: int = 6) -> str:
    return f"round(CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END, {digits})"


def _uniform(text: str) -> str:
    """A number in (0, 1) from the MD5 of a text."""
    return f"((CAST('0x' || left(md5({text}), 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _normal(key: str, seed: int) -> str:
    """A standard normal draw from the MD5 of a text."""

    def uniform(stream: int) -> str:
        return _uniform(f"{key} || '|{seed}|{stream}'")

    return f"(sqrt(-2.0 * ln({uniform(1)})) * cos(2.0 * pi() * {uniform(2)}))"


# --------------------------------------------------------------------------- news


@query(
    _with(SHORT_NEWS)
    + """SELECT day_s AS "Day", CAST(left(regexp_replace(text, '[^0-9]', '', 'g'), 8) AS INTEGER) AS day_key,
         CAST(CAST(try_strptime(day_s, '%Y%m%d') AS DATE) AS VARCHAR) AS event_date, count(*) AS n
  FROM (SELECT day_s, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text FROM news JOIN events ON GlobalEventID = event_id + 100000)
  GROUP BY 1, 2, 3"""
)
def day_key(spark, d):
    """Digits of a full time stamp text, cut to a day, next to the parsed day."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return (
        data.table(spark, d, "events")
        .select(
            F.date_format("ts", "yyyyMMdd").alias("Day"),
            cleaning.day_key(text).alias("day_key"),
            cleaning.parse_day(F.date_format("ts", "yyyyMMdd")).cast("string").alias("event_date"),
        )
        .groupBy("Day", "day_key", "event_date")
        .agg(F.count("*").alias("n"))
    )


@query(_with(SHORT_NEWS, DAILY) + "SELECT CAST(event_date AS VARCHAR) AS event_date, news_count, round(avg_conflict_score, 6) AS avg_conflict_score FROM daily")
def daily_news(spark, d):
    daily = gold.aggregate_news(data.short_news(spark, d))
    return _dates_as_text(_rounded(daily, "avg_conflict_score"), "event_date")


@query(_with(LONG_NEWS, DAILY) + "SELECT CAST(event_date AS VARCHAR) AS event_date, news_count, round(avg_conflict_score, 6) AS avg_conflict_score FROM daily")
def daily_news_long(spark, d):
    daily = gold.aggregate_news(data.long_news(spark, d))
    return _dates_as_text(_rounded(daily, "avg_conflict_score"), "event_date")


@query(
    _with(LONG_NEWS)
    + """SELECT CAST(CAST(date_trunc('week', try_strptime(day_s, '%Y%m%d')) AS DATE) AS VARCHAR) AS event_date,
         count(*) AS news_count, round(avg(-Tone), 6) AS avg_conflict_score FROM news GROUP BY 1"""
)
def weekly_news(spark, d):
    weekly = gold.aggregate_news(data.long_news(spark, d), grain="week")
    return _dates_as_text(_rounded(weekly, "avg_conflict_score"), "event_date")


@query(
    _with(LONG_NEWS)
    + """SELECT GlobalEventID, day_s AS "Day", round(Tone, 6) AS Tone FROM news
  WHERE CAST(try_strptime(day_s, '%Y%m%d') AS DATE) BETWEEN DATE '1996-10-19' AND DATE '1997-02-08'"""
)
def study_window(spark, d):
    dated = data.long_news(spark, d).withColumn("event_date", cleaning.parse_day("Day"))
    kept = cleaning.study_window(dated, "1996-10-19", "1997-02-08")
    return _rounded(kept.select("GlobalEventID", "Day", "Tone"), "Tone")


@query(
    _with(SHORT_NEWS)
    + """SELECT day_s AS "Day", SourceURL, round(Tone, 6) AS Tone FROM (
    SELECT *, row_number() OVER (PARTITION BY day_s ORDER BY SourceURL, Tone) AS rn FROM news) WHERE rn <= 250"""
)
def news_cap(spark, d):
    kept = ordering.cap_per_group(data.short_news(spark, d), "Day", ["SourceURL", "Tone"], fixed.MAX_ARTICLES_PER_DAY)
    return _rounded(kept.select("Day", "SourceURL", "Tone"), "Tone")


@query(
    """SELECT source, doc_id, n_chars FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents)
  WHERE rn <= 20"""
)
def source_cap(spark, d):
    docs = data.table(spark, d, "documents").select("source", "doc_id", "n_chars")
    return ordering.cap_per_group(docs, "source", [F.desc("n_chars"), "doc_id"], 20)


@query(
    _with(SHORT_NEWS)
    + """SELECT 99999 + row_number() OVER (ORDER BY day_s, SourceURL, Tone) AS GlobalEventID,
         day_s AS "Day", SourceURL, round(Tone, 6) AS Tone FROM news"""
)
def dense_ids(spark, d):
    news = data.short_news(spark, d).select("Day", "SourceURL", "Tone")
    return _rounded(ordering.dense_ids(news, "Day", ["SourceURL", "Tone"]), "Tone")


def _write_exports(spark: SparkSession, d: str) -> str:
    """All events as raw text exports: two spellings of the header, two of the date, in two folders."""
    base = scratch_path(spark, "exports")
    events = data.table(spark, d, "events").select(
        "ts",
        "event_type",
        F.concat(F.lit("  "), F.concat_ws("/", "event_type", F.col("user_id").cast("string"))).alias("u"),
        (-F.col("value") / F.pi()).cast("string").alias("t"),
    )
    first = F.col("event_type").isin("view", "click")
    events.where(first).select(
        F.col("u").alias("URL"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'").alias("Date"), F.col("t").alias("Tone")
    ).write.csv(f"{base}/a", header=True, ignoreLeadingWhiteSpace=False)
    events.where(~first).select(
        F.date_format("ts", "yyyyMMdd").alias("date"), F.col("t").alias("AvgTone"), F.col("u").alias("url")
    ).write.csv(f"{base}/b", header=True, ignoreLeadingWhiteSpace=False)
    return f"{base}/*"


@query(
    _with(SHORT_NEWS)
    + """SELECT day_s AS "Day", Country, round(Tone, 6) AS Tone, SourceURL FROM news"""
)
def clean_news(spark, d):
    raw = read_raw_exports(spark, _write_exports(spark, d))
    return _rounded(cleaning.clean_news(raw), "Tone")


@query(
    _with(SHORT_NEWS)
    + """SELECT 99999 + row_number() OVER (ORDER BY day_s, SourceURL, Tone) AS GlobalEventID,
         day_s AS "Day", Country, round(Tone, 6) AS Tone, SourceURL
  FROM news"""
)
def ingest_exports(spark, d):
    """Exports to numbered news: read, clean, give ids."""
    return _rounded(news_from_exports(spark, _write_exports(spark, d)), "Tone")


@query(
    """SELECT CASE WHEN event_type = 'error' THEN 'date' WHEN event_type = 'signup' THEN 'url' ELSE 'tone' END AS reject_reason,
         count(*) AS n
  FROM events WHERE event_type IN ('error', 'signup') OR value < 20 GROUP BY 1"""
)
def reject_reasons(spark, d):
    """Events with spoilt fields: errors lose their date, signups their url, small values their tone."""
    raw = data.table(spark, d, "events").select(
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("Date"),
        F.when(F.col("event_type") == "signup", "  ").otherwise(F.col("event_type")).alias("url"),
        F.when(F.col("value") < 20, "low").otherwise((-F.col("value")).cast("string")).alias("AvgTone"),
    )
    _, rejects = cleaning.clean_news(raw, keep_rejects=True, tone_policy="drop")
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(
    f"""SELECT strftime(ts, '%Y%m%d') AS "Day", event_type AS SourceURL, round(CASE WHEN value >= 20 THEN -value
    ELSE -5.0 + 2.0 * {_normal("strftime(ts, '%Y-%m-%d %H:%M') || '|' || event_type || '|low'", 7)} END, 6) AS Tone
  FROM events"""
)
def tone_fallback(spark, d):
    """Events whose small values are no number: their tone is drawn."""
    raw = data.table(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("Date"),
        F.col("event_type").alias("url"),
        F.when(F.col("value") < 20, "low").otherwise((-F.col("value")).cast("string")).alias("AvgTone"),
    )
    news = cleaning.clean_news(raw, tone_policy="hash_normal", seed=7)
    return _rounded(news.select("Day", "SourceURL", "Tone"), "Tone")


@query(
    """WITH news AS (
    SELECT CASE event_type WHEN 'error' THEN '20240230' WHEN 'signup' THEN '2024' ELSE strftime(ts, '%Y%m%d') END AS day_s,
           -value / pi() AS Tone FROM events),"""
    + DAILY
    + """ SELECT CAST(event_date AS VARCHAR) AS event_date, news_count, round(avg_conflict_score, 6) AS avg_conflict_score
  FROM daily"""
)
def bad_days(spark, d):
    """Days that no calendar has, and days cut short, share the row without a date."""
    day = F.when(F.col("event_type") == "error", "20240230").when(F.col("event_type") == "signup", "2024")
    news = data.table(spark, d, "events").select(
        F.coalesce(day, F.date_format("ts", "yyyyMMdd")).alias("Day"), (-F.col("value") / F.pi()).alias("Tone")
    )
    return _dates_as_text(_rounded(gold.aggregate_news(news), "avg_conflict_score"), "event_date")


@query(
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'URL,Date,Tone' ELSE 'date,AvgTone,url' END AS header,
         true AS is_data, count(*) AS n_rows
  FROM events GROUP BY 1"""
)
def export_files(spark, d):
    """Lines of the export files by header, without the header lines."""
    files = data_files(spark, _write_exports(spark, d))
    return files.groupBy("header", "is_data").agg(F.sum(F.col("n_lines") - 1).alias("n_rows"))


@query(
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'URL,Date,Tone' ELSE 'date,AvgTone,url' END AS header,
         event_type IN ('view', 'click') AS is_data, count(*) AS n_rows
  FROM events GROUP BY 1, 2"""
)
def export_files_strict(spark, d):
    """As above, with files told from their text: only one of the two headers has a mark."""
    files = data_files(spark, _write_exports(spark, d), strict_sniff=True)
    return files.groupBy("header", "is_data").agg(F.sum(F.col("n_lines") - 1).alias("n_rows"))


@query(_with(SHORT_NEWS) + """SELECT GlobalEventID, day_s AS "Day", Country, round(Tone, 6) AS Tone, SourceURL FROM news""")
def news_csv(spark, d):
    """News written as CSV and read back with the declared schema."""
    path = scratch_path(spark, "news-csv")
    write_csv(data.short_news(spark, d), path)
    return _rounded(read_news_csv(spark, path), "Tone")


@query(_with(LONG_WEEKLY) + """SELECT "Date", Route, round(Price, 6) AS Price FROM weekly""")
def rates_csv(spark, d):
    """Weekly prices written as CSV and read back with the declared schema."""
    path = scratch_path(spark, "rates-csv")
    write_csv(data.long_weekly(spark, d), path)
    return _rounded(read_rates_csv(spark, path), "Price")


@query(
    _with(LONG_NEWS)
    + """SELECT GlobalEventID, day_s AS "Day", round(Tone, 6) AS Tone FROM news
  WHERE CAST(try_strptime(day_s, '%Y%m%d') AS DATE) BETWEEN DATE '1996-10-19' AND DATE '1997-02-08'"""
)
def stored_news(spark, d):
    """News written by month, then read back for a study window that prunes months."""
    path = scratch_path(spark, "news")
    write_news(data.long_news(spark, d), path)
    kept = cleaning.study_window(read_table(spark, path, schemas.STORED_NEWS), "1996-10-19", "1997-02-08")
    return _rounded(kept.select("GlobalEventID", "Day", "Tone"), "Tone")


POSITIVE = ("with", "for", "only", "pour", "para", "und")
NEGATIVE = ("that", "this", "than", "nicht", "avec", "dans", "not")
PHRASES = ("only", "for the", "nicht", "dans le")

_WORDS = r"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: w <> '') AS w FROM documents),
tones AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN NULL ELSE
    100.0 * (len(list_filter(w, lambda x: x IN ('with', 'for', 'only', 'pour', 'para', 'und')))
           - len(list_filter(w, lambda x: x IN ('that', 'this', 'than', 'nicht', 'avec', 'dans', 'not')))) / len(w)
    END AS Tone
  FROM words)"""


@query(_with(_WORDS) + "SELECT doc_id, round(Tone, 6) AS Tone FROM tones", name="lexicon_tone")
def lexicon_tones(spark, d):
    return _rounded(lexicon_tone(data.table(spark, d, "documents"), POSITIVE, NEGATIVE), "Tone")


@query(
    _with(_WORDS)
    + r"""SELECT d.doc_id, d.source, round(t.Tone, 6) AS Tone FROM documents d JOIN tones t USING (doc_id)
  WHERE t.Tone < -0.5
    AND regexp_matches(lower(d.text), '(^|[^\p{L}\p{N}])(only|for the|nicht|dans le)([^\p{L}\p{N}]|$)')"""
)
def match_news(spark, d):
    docs = with_lexicon_tone(data.table(spark, d, "documents"), POSITIVE, NEGATIVE)
    kept = cleaning.match_news(docs, "text", PHRASES, max_tone=-0.5)
    return _rounded(kept.select("doc_id", "source", "Tone"), "Tone")


# --------------------------------------------------------------------------- prices and gold


@query(_with(SHORT_WEEKLY, HOURLY) + 'SELECT "Date", Route, round(Price, 6) AS Price FROM hourly')
def hourly_rates(spark, d):
    return _rounded(data.short_hourly(spark, d), "Price")


@query(_with(LONG_WEEKLY, HOURLY) + 'SELECT "Date", Route, round(Price, 4) AS Price FROM hourly')
def hourly_rates_multi(spark, d):
    return _rounded(data.long_hourly(spark, d), "Price", digits=4)


@query(
    _with(LONG_WEEKLY)
    + """SELECT Route, CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS TIMESTAMP) AS "Date"
  FROM weekly GROUP BY Route"""
)
def daily_spine(spark, d):
    return upsample.time_spine(data.long_weekly(spark, d), step="1 day")


@query(
    _with(SHORT_NEWS, SHORT_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round(Price, 6) AS Price, news_count, round(avg_conflict_score, 6) AS avg_conflict_score
  FROM gold""",
    name="gold",
)
def gold_hourly(spark, d):
    return _rounded(data.short_gold(spark, d), "Price", "avg_conflict_score")


@query(
    _with(LONG_NEWS, LONG_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round(Price, 4) AS Price, news_count, round(avg_conflict_score, 4) AS avg_conflict_score, Route
  FROM gold"""
)
def gold_by_route(spark, d):
    return _rounded(data.long_gold(spark, d), "Price", "avg_conflict_score", digits=4)


@query(
    _with(LONG_NEWS, LONG_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round(Price, 4) AS Price, news_count, round(avg_conflict_score, 4) AS avg_conflict_score
  FROM gold ORDER BY full_date"""
)
def stored_gold(spark, d):
    """Gold written if not empty, then read back in order."""
    path = scratch_path(spark, "gold")
    write_if_nonempty(data.long_gold(spark, d), path)
    return _rounded(read_gold(spark, path), "Price", "avg_conflict_score", digits=4)


@query(
    _with(LONG_WEEKLY, HOURLY)
    + f"""SELECT "Date", Route, round_even(Price + 5.0 * {_normal("Route || '|' || CAST(\"Date\" AS VARCHAR)", 1)}, 2) AS Price
  FROM hourly"""
)
def noisy_rates(spark, d):
    """Jittered prices, rounded to cents."""
    return upsample.upsample_rates(data.long_weekly(spark, d), noise_sd=5.0, seed=1)


@query(
    _with(LONG_WEEKLY)
    + """, holed AS (
    SELECT "Date", Route, CASE WHEN month("Date") IN (1, 4, 7, 8, 12) THEN NULL ELSE Price END AS Price FROM weekly),
  grid AS (
    SELECT Route, CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 HOUR)) AS TIMESTAMP) AS "Date"
    FROM holed GROUP BY Route),
  anchors AS (
    SELECT Route, "Date" AS held_at, Price AS v, lead("Date") OVER w AS next_at, lead(Price) OVER w AS next_v
    FROM holed WHERE Price IS NOT NULL WINDOW w AS (PARTITION BY Route ORDER BY "Date"))
  SELECT g."Date", g.Route, round(CASE WHEN next_at IS NULL THEN v
    ELSE v + (next_v - v) * date_diff('hour', held_at, g."Date") / date_diff('hour', held_at, next_at) END, 4) AS Price
  FROM grid g ASOF LEFT JOIN anchors a ON a.Route = g.Route AND g."Date" >= a.held_at"""
)
def hourly_rates_nulls(spark, d):
    """Weeks without a price at the start, in the middle and at the end of each route."""
    holed = data.long_weekly(spark, d).withColumn(
        "Price", F.when(~F.month("Date").isin(1, 4, 7, 8, 12), F.col("Price"))
    )
    return _rounded(upsample.upsample_linear(holed), "Price", digits=4)


@query(_with(LONG_WEEKLY, HOURLY) + 'SELECT "Date", Route, round(Price, 4) AS Price FROM hourly')
def stored_rates(spark, d):
    """Hourly prices written, then read back with the declared schema."""
    path = scratch_path(spark, "rates")
    write_rates(data.long_hourly(spark, d), path)
    return _rounded(read_table(spark, path, schemas.RATES), "Price", digits=4)


@query(
    _with(LONG_NEWS, LONG_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round(Price, 4) AS Price, news_count, round(avg_conflict_score, 4) AS avg_conflict_score, Route
  FROM gold"""
)
def stored_gold_by_route(spark, d):
    """Gold stored with its route, and read back with it."""
    path = scratch_path(spark, "gold")
    write_if_nonempty(data.long_gold(spark, d), path)
    return _rounded(read_gold(spark, path, keep_route=True), "Price", "avg_conflict_score", digits=4)


@query(
    _with(SHORT_NEWS, SHORT_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round(Price, 6) AS Price, news_count, round(avg_conflict_score, 6) AS avg_conflict_score
  FROM gold"""
)
def gold_kept_when_empty(spark, d):
    """An empty gold table doesn't replace the one that is stored."""
    path = scratch_path(spark, "gold")
    frame = data.short_gold(spark, d)
    write_if_nonempty(frame, path)
    write_if_nonempty(frames.filter_dates(frame, "2030-01-01", "2030-01-31"), path)
    return _rounded(read_gold(spark, path), "Price", "avg_conflict_score")


@query(
    _with(SHORT_NEWS, SHORT_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT 'news' AS target, count(*) AS n FROM news UNION ALL SELECT 'rates', count(*) FROM hourly
  UNION ALL SELECT 'gold', count(*) FROM gold UNION ALL SELECT 'empty gold', 0"""
)
def write_counts(spark, d):
    """What each writer says it has written."""
    path = scratch_path(spark, "counts")
    frame = data.short_gold(spark, d)
    counts = {
        "news": write_news(data.short_news(spark, d), f"{path}/news"),
        "rates": write_rates(data.short_hourly(spark, d), f"{path}/rates"),
        "gold": write_if_nonempty(frame, f"{path}/gold"),
        "empty gold": write_if_nonempty(frames.filter_dates(frame, "2030-01-01", "2030-01-31"), f"{path}/gold"),
    }
    return spark.createDataFrame(list(counts.items()), "target string, n long")


@query(
    _with(SHORT_NEWS, SHORT_WEEKLY, DAILY, HOURLY, GOLD)
    + """SELECT full_date, round_even(Price, 2) AS Price, news_count, round(avg_conflict_score, 6) AS avg_conflict_score,
         round_even(news_count * avg_conflict_score, 2) AS Risk_Score FROM gold"""
)
def frame_half_even(spark, d):
    """The frame with ties to even and the conflict score as it is."""
    return _rounded(frames.risk_score(data.short_gold(spark, d), round_score=False), "avg_conflict_score")


@query(SHORT + "SELECT full_date, Price, news_count, avg_conflict_score, Risk_Score FROM frame")
def analysis_frame(spark, d):
    return data.short_frame(spark, d)


@query(
    LONG
    + """SELECT Period, count(*) AS n, min(full_date) AS first_date, max(full_date) AS last_date FROM (
    SELECT *, CASE WHEN year(full_date) >= 1998 THEN 'Crisis (2024)' ELSE 'Baseline (2023)' END AS Period FROM frame)
  GROUP BY 1"""
)
def with_period(spark, d):
    return (
        frames.with_period(data.long_frame(spark, d), 1998)
        .groupBy("Period")
        .agg(F.count("*").alias("n"), F.min("full_date").alias("first_date"), F.max("full_date").alias("last_date"))
    )


# --------------------------------------------------------------------------- dashboard

_KPI = f"""SELECT max(Price) AS peak_price, CAST(sum(news_count) AS BIGINT) AS total_events,
  {_corr('Price', 'Risk_Score')} AS correlation FROM frame"""


@query(SHORT + _KPI + " WHERE CAST(full_date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'")
def kpi_dates(spark, d):
    kept = frames.filter_dates(data.short_frame(spark, d), "2024-01-05", "2024-01-25")
    return _rounded(stats.kpis(kept), "correlation")


@query(
    SHORT + _KPI + " WHERE full_date BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'"
)
def kpi_instants(spark, d):
    kept = frames.filter_instants(data.short_frame(spark, d), "2024-01-05", "2024-01-25")
    return _rounded(stats.kpis(kept), "correlation")


@query(
    SHORT
    + """SELECT '$' || format('{:,.0f}', max(Price)) AS peak_price,
  format('{:,}', CAST(sum(news_count) AS BIGINT)) AS total_events,
  coalesce(format('{:.2f}', CASE WHEN isnan(corr(Price, Risk_Score)) THEN NULL ELSE corr(Price, Risk_Score) END), 'N/A')
    AS correlation FROM frame"""
)
def kpi_formatted(spark, d):
    return stats.kpis(data.short_frame(spark, d), formatted=True)


@query(
    SHORT
    + """SELECT coalesce('$' || format('{:,.0f}', max(Price)), '-') AS peak_price,
  coalesce(format('{:,}', CAST(sum(news_count) AS BIGINT)), '-') AS total_events,
  coalesce(format('{:.2f}', corr(Price, Risk_Score)), '-') AS correlation
  FROM frame WHERE full_date > TIMESTAMP '2030-01-01 00:00:00'"""
)
def kpi_empty_window(spark, d):
    """A window behind all data still gives one row."""
    late = frames.filter_dates(data.short_frame(spark, d), "2030-01-02", "2030-01-31")
    return stats.kpis(late, formatted=True, placeholder="-")


@query(
    SHORT
    + """SELECT CAST(sum(n) AS BIGINT) AS total_events FROM (
    SELECT CAST(full_date AS DATE) AS day, max(news_count) AS n FROM frame GROUP BY 1)"""
)
def total_events_distinct(spark, d):
    return stats.total_events(data.short_frame(spark, d), distinct_days=True)


@query(
    SHORT
    + """SELECT full_date, Price, Risk_Score FROM frame
  WHERE CAST(full_date AS DATE) >= greatest(DATE '2023-11-15', (SELECT CAST(min(full_date) AS DATE) FROM frame))
    AND CAST(full_date AS DATE) <= least(DATE '2024-01-31', (SELECT CAST(max(full_date) AS DATE) FROM frame))"""
)
def default_window(spark, d):
    return frames.default_window(data.short_frame(spark, d)).select("full_date", "Price", "Risk_Score")


@query(
    SHORT
    + """SELECT full_date, Price, Risk_Score FROM frame
  WHERE CAST(full_date AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-19'"""
)
def default_window_clipped(spark, d):
    """A window inside the data, which drops days at both ends."""
    kept = frames.default_window(data.short_frame(spark, d), "2024-01-09", "2024-01-19")
    return kept.select("full_date", "Price", "Risk_Score")


@query(
    SHORT
    + """SELECT CAST(greatest(DATE '2023-11-15', CAST(min(full_date) AS DATE)) AS VARCHAR) AS start_date,
  CAST(least(DATE '2024-01-31', CAST(max(full_date) AS DATE)) AS VARCHAR) AS end_date FROM frame"""
)
def default_bounds(spark, d):
    return _dates_as_text(frames.default_bounds(data.short_frame(spark, d)), "start_date", "end_date")


@query(LONG + "SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM frame")
def bounds(spark, d):
    return frames.bounds(data.long_frame(spark, d))


_WINDOW = "FROM frame WHERE CAST(full_date AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"


def _two_weeks(spark: SparkSession, d: str) -> DataFrame:
    return frames.filter_dates(data.short_frame(spark, d), "2024-01-08", "2024-01-21")


@query(SHORT + f"SELECT full_date, Risk_Score, Price {_WINDOW} ORDER BY full_date")
def trend(spark, d):
    return frames.trend(_two_weeks(spark, d))


@query(SHORT + f"SELECT full_date, avg_conflict_score, news_count, Price {_WINDOW} ORDER BY full_date")
def panic_meter(spark, d):
    return frames.panic_meter(_two_weeks(spark, d))


@query(SHORT + f"SELECT full_date, Risk_Score {_WINDOW} ORDER BY full_date")
def risk_line(spark, d):
    return frames.risk_line(_two_weeks(spark, d))


@query(
    SHORT + f"SELECT full_date, Price, news_count, avg_conflict_score, Risk_Score {_WINDOW} ORDER BY full_date DESC"
)
def raw_table(spark, d):
    return frames.raw_table(_two_weeks(spark, d))


@query(
    SHORT + "SELECT full_date, Price, news_count, avg_conflict_score, Risk_Score FROM frame ORDER BY full_date LIMIT 5"
)
def head(spark, d):
    return frames.head(data.short_frame(spark, d))


# --------------------------------------------------------------------------- statistics

_COLS = ("Price", "news_count", "avg_conflict_score", "Risk_Score")


@query(
    LONG
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {_corr(x, y)} AS r FROM frame" for x in _COLS for y in _COLS
    )
)
def corr_matrix(spark, d):
    return _rounded(stats.corr_matrix(data.long_frame(spark, d)), "r")


@query(
    LONG
    + """SELECT round(regr_slope(Price, Risk_Score), 4) AS slope, round(regr_intercept(Price, Risk_Score), 2) AS intercept,
  round(regr_r2(Price, Risk_Score), 6) AS r2, CAST(regr_count(Price, Risk_Score) AS BIGINT) AS n FROM frame"""
)
def ols(spark, d):
    fit = stats.ols(data.long_frame(spark, d))
    return fit.select(_r("slope", 4), _r("intercept", 2), _r("r2"), "n")


@query(
    LONG
    + """, ends AS (SELECT min(Risk_Score) AS lo, max(Risk_Score) AS hi FROM frame),
  counts AS (
    SELECT least(CAST(floor(40 * (Risk_Score - lo) / (hi - lo)) AS BIGINT) + 1, 40) AS bin, count(*) AS n
    FROM frame, ends GROUP BY 1)
  SELECT b.bin, round(lo + (hi - lo) / 40 * (b.bin - 1), 6) AS lo, round(lo + (hi - lo) / 40 * b.bin, 6) AS hi,
         coalesce(c.n, 0) AS n
  FROM (SELECT unnest(range(1, 41)) AS bin) b CROSS JOIN ends LEFT JOIN counts c ON b.bin = c.bin"""
)
def histogram(spark, d):
    return _rounded(stats.histogram(data.long_frame(spark, d)), "lo", "hi")


@query(
    LONG
    + """, vals AS (SELECT Risk_Score AS v, count(*) AS c FROM frame GROUP BY 1),
  facts AS (
    SELECT min(Risk_Score) AS lo, max(Risk_Score) AS hi, count(*) AS n,
           stddev_samp(Risk_Score) * pow(count(*), -0.2) AS w FROM frame),
  grid AS (SELECT lo + (hi - lo) / 199 * i AS x, n, w FROM facts, range(0, 200) t(i))
  SELECT round(x, 6) AS x, round(sum(c * exp(-0.5 * pow((x - v) / w, 2))) / (any_value(n * w) * sqrt(2 * pi())), 8) AS density
  FROM grid, vals GROUP BY x"""
)
def density(spark, d):
    curve = stats.density(data.long_frame(spark, d))
    return curve.select(_r("x"), _r("density", 8))


@query(
    LONG
    + """, labelled AS (
    SELECT CASE WHEN year(full_date) >= 1998 THEN 'Crisis (2024)' ELSE 'Baseline (2023)' END AS Period, Price FROM frame),
  boxes AS (
    SELECT Period, count(*) AS n, quantile_cont(Price, 0.25) AS q1, quantile_cont(Price, 0.5) AS median,
           quantile_cont(Price, 0.75) AS q3 FROM labelled GROUP BY 1)
  SELECT b.Period, b.n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
    round(least(min(Price) FILTER (Price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q1), 4) AS whisker_lo,
    round(greatest(max(Price) FILTER (Price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q3), 4) AS whisker_hi,
    count(*) FILTER (NOT Price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
  FROM labelled l JOIN boxes b ON l.Period = b.Period GROUP BY b.Period, b.n, q1, median, q3"""
)
def box_stats(spark, d):
    boxes = stats.box_stats(frames.with_period(data.long_frame(spark, d), 1998))
    return _rounded(boxes, "q1", "median", "q3", "whisker_lo", "whisker_hi", digits=4)


@query(
    LONG
    + f"""SELECT count(*) AS n_rows, min(full_date) AS min_date, max(full_date) AS max_date,
  max(Risk_Score) AS max_risk, max(Price) AS max_price, {_corr('Risk_Score', 'Price', 3)} AS r FROM frame"""
)
def summary(spark, d):
    return stats.summary(data.long_frame(spark, d))


@query(
    LONG
    + """SELECT max(Price) AS peak_price, round(avg(Price) FILTER (year(full_date) < 1998), 4) AS baseline_price,
  round((max(Price) / avg(Price) FILTER (year(full_date) < 1998) - 1) * 100, 6) AS uplift_pct FROM frame"""
)
def uplift(spark, d):
    row = stats.uplift(data.long_frame(spark, d), 1998)
    return row.select("peak_price", _r("baseline_price", 4), _r("uplift_pct"))


@query(
    SHORT
    + f""", complete AS (
    SELECT CAST(floor({_uniform("CAST(full_date AS VARCHAR) || '|0|1'")} * 65536) AS BIGINT) AS block,
           Risk_Score AS x, Price AS y FROM frame WHERE Risk_Score IS NOT NULL AND Price IS NOT NULL),
  facts AS (SELECT min(x) AS lo, max(x) AS hi, avg(x) AS mean FROM complete),
  blocks AS (
    SELECT block, count(*) AS n, sum(x - mean) AS sx, sum(y) AS sy, sum((x - mean) * (x - mean)) AS sxx, sum((x - mean) * y) AS sxy
    FROM complete, facts GROUP BY 1),
  draws AS (SELECT *, {_uniform("block || '|' || rep || '|0|0'")} AS u FROM blocks, range(1, 1001) r(rep)),
  weighted AS (SELECT *, {" + ".join(f"CAST(u > {p!r} AS INTEGER)" for p in stats.POISSON_STEPS)} AS w FROM draws),
  sums AS (
    SELECT rep, sum(w * n) AS n, sum(w * sx) AS sx, sum(w * sy) AS sy, sum(w * sxx) AS sxx, sum(w * sxy) AS sxy
    FROM weighted WHERE w > 0 GROUP BY 1),
  lines AS (
    SELECT slope, (sy - slope * sx) / n AS intercept
    FROM (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM sums)),
  grid AS (SELECT lo + (hi - lo) / 99 * i AS x, mean FROM facts, range(0, 100) t(i))
  SELECT round(x, 6) AS x, round(quantile_cont(intercept + slope * (x - mean), 0.025), 4) AS lo,
         round(quantile_cont(intercept + slope * (x - mean), 0.975), 4) AS hi
  FROM grid, lines GROUP BY x"""
)
def ols_band(spark, d):
    """Bootstrap with draws from MD5."""
    band = stats.ols_band(data.short_frame(spark, d), keys=["full_date"], portable=True)
    return band.select(_r("x"), _r("lo", 4), _r("hi", 4))


# --------------------------------------------------------------------------- series


@query(
    LONG_DAILY
    + """SELECT Route, CAST(day AS VARCHAR) AS day, round(avg_price, 6) AS avg_price, close_price, news_count, avg_conflict_score,
  round(Risk_Score, 6) AS Risk_Score FROM per_day"""
)
def to_daily(spark, d):
    daily = series.to_daily(data.long_frame(spark, d), ["Route"])
    return daily.select(
        "Route", _text("day"), _r("avg_price"), "close_price", "news_count", "avg_conflict_score", _r("Risk_Score")
    )


@query(
    LONG_DAILY
    + f""", scan AS (
    SELECT r.Route, CAST(k.lag AS INTEGER) AS lag, count(*) AS n, {_corr('r.Risk_Score', 'p.avg_price', 12)} AS r
    FROM per_day r CROSS JOIN (SELECT unnest(range(0, 31)) AS lag) k
    JOIN per_day p ON p.Route = r.Route AND p.day = r.day + CAST(k.lag AS INTEGER)
    GROUP BY 1, 2)
  SELECT Route, lag, n, round(r, 6) AS r,
         CAST(row_number() OVER (PARTITION BY Route ORDER BY r DESC NULLS LAST, lag) AS INTEGER) AS rank
  FROM scan"""
)
def lag_scan(spark, d):
    scan = series.lag_scan(series.to_daily(data.long_frame(spark, d), ["Route"]), 30, ["Route"])
    return _rounded(scan, "r")


@query(
    LONG_DAILY
    + """SELECT Route, CAST(day AS VARCHAR) AS day, round(Risk_Score, 6) AS Risk_Score,
  round(sum(Risk_Score) OVER (PARTITION BY Route ORDER BY day ROWS UNBOUNDED PRECEDING), 4) AS cumulative_risk
  FROM per_day"""
)
def cumulative_risk(spark, d):
    total = series.cumulative_risk(series.to_daily(data.long_frame(spark, d), ["Route"]), ["Route"])
    return total.select("Route", _text("day"), _r("Risk_Score"), _r("cumulative_risk", 4))


@query(
    LONG_DAILY.rstrip() + "," + RETURNS
    + """ SELECT Route, CAST(day AS VARCHAR) AS day, close_price, round(daily_return, 8) AS daily_return,
  round(CASE WHEN count(daily_return) OVER w > 1 THEN stddev_samp(daily_return) OVER w END, 8) AS rolling_sd
  FROM returns WINDOW w AS (PARTITION BY Route ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
)
def volatility(spark, d):
    rough = series.volatility(series.to_daily(data.long_frame(spark, d), ["Route"]), 7, ["Route"])
    return _dates_as_text(_rounded(rough, "daily_return", "rolling_sd", digits=8), "day")


@query(
    LONG_DAILY.rstrip() + "," + RETURNS
    + f""", squares AS (
    SELECT Route, daily_return * daily_return AS sq,
           lag(daily_return * daily_return) OVER (PARTITION BY Route ORDER BY day) AS before FROM returns)
  SELECT Route, count(before) AS n, {_corr('sq', 'before')} AS autocorrelation FROM squares GROUP BY 1"""
)
def volatility_clustering(spark, d):
    clustering = series.volatility_clustering(series.to_daily(data.long_frame(spark, d), ["Route"]), ["Route"])
    return _rounded(clustering, "autocorrelation")


# --------------------------------------------------------------------------- streams

_CLOSED = """closed AS (
  SELECT CAST(ts AS DATE) AS event_date, count(*) AS news_count, avg(value / pi()) AS avg_conflict_score
  FROM events GROUP BY 1
  HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events))"""

_CLOSED_DAYS = f"WITH {_CLOSED} SELECT CAST(event_date AS VARCHAR) AS event_date, news_count, round(avg_conflict_score, 6) AS avg_conflict_score FROM closed"


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    batch = data.table(spark, d, "events")
    return (
        spark.readStream.schema(batch.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
        .select(
            "event_id",
            "ts",
            (-F.col("value") / F.pi()).alias("Tone"),
            F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("SourceURL"),
        )
    )


@contextmanager
def _state_by_cores(spark: SparkSession):
    """No more state partitions than cores: each costs a state file per operator and batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), cores)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _drain(stream: DataFrame) -> DataFrame:
    """Run a stream over what is there, into files of the shared folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream")
    with _state_by_cores(spark):
        running = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{out}/data")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


@query(_CLOSED_DAYS, name="stream_daily")
def stream_days(spark, d):
    days = _drain(stream_daily(_event_stream(spark, d)))
    return _dates_as_text(_rounded(days, "avg_conflict_score"), "event_date")


@query(_CLOSED_DAYS, name="stream_dedup")
def stream_days_dedup(spark, d):
    """Every event arrives twice; each is counted once."""
    twice = _event_stream(spark, d).union(_event_stream(spark, d))
    days = _drain(stream_daily_dedup(twice, "event_id"))
    return _dates_as_text(_rounded(days, "avg_conflict_score"), "event_date")


@query(
    _with(SHORT_WEEKLY, HOURLY)
    + f""", {_CLOSED}
  SELECT h."Date" AS full_date, round(h.Price, 6) AS Price, c.news_count, round(c.avg_conflict_score, 6) AS avg_conflict_score
  FROM hourly h JOIN closed c ON CAST(h."Date" AS DATE) = c.event_date""",
    name="stream_gold",
)
def stream_gold_days(spark, d):
    """Closed days joined to hourly prices, stored day by day."""
    out = scratch_path(spark, "stream-gold")
    events, prices = _event_stream(spark, d), data.short_hourly(spark, d)
    with _state_by_cores(spark):
        stream_gold(events, prices, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    stored = spark.read.parquet(f"{out}/data").select("full_date", "Price", "news_count", "avg_conflict_score")
    return _rounded(stored, "Price", "avg_conflict_score")
