"""Registered queries of operators for large keys, long lists and stored state, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swellmark import fixed, schemas
from swellmark.operators import cleaning, density, frames, ordering, phrases, selection, series, sketches, upsample
from swellmark.operators.tone import with_lexicon_tone
from swellmark.plans import adapters as data
from swellmark.plans.catalog import (
    _WORDS,
    HOURLY,
    LONG,
    LONG_DAILY,
    LONG_NEWS,
    LONG_WEEKLY,
    NEGATIVE,
    ORACLE,
    POSITIVE,
    QUERIES,
    RETURNS,
    SHORT,
    SHORT_NEWS,
    _dates_as_text,
    _r,
    _rounded,
    _text,
    _with,
    _write_exports,
    query,
)
from swellmark.session import scratch_path
from swellmark.sources.exports import read_exports_by_line
from swellmark.sources.footers import footer_bounds
from swellmark.sources.sinks import write_news
from swellmark.sources.snapshots import SnapshotTable
from swellmark.streaming.ingest import ExportStore, export_stream, stream_exports
from swellmark.streaming.restate import late_table, restated_days, stream_restated

__all__ = ["ORACLE", "QUERIES"]

# --------------------------------------------------------------------------- quantiles and density


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(min(l_extendedprice), 6) AS q_0,
    round(quantile_cont(l_extendedprice, 0.1), 6) AS q_1, round(quantile_cont(l_extendedprice, 0.5), 6) AS q_2,
    round(quantile_cont(l_extendedprice, 0.999), 6) AS q_3, round(max(l_extendedprice), 6) AS q_4
  FROM lineitem GROUP BY ALL"""
)
def radix_quantiles(spark, d):
    """Quantiles of a stored table, each pass a scan of three columns."""
    lines = data.table(spark, d, "lineitem")
    found = selection.radix_quantiles(
        lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.0, 0.1, 0.5, 0.999, 1.0], rescan=True
    )
    return _rounded(found, *[f"q_{i}" for i in range(5)])


@query(ORACLE["box_stats"])
def radix_box_stats(spark, d):
    boxes = selection.radix_box_stats(frames.with_period(data.long_frame(spark, d), 1998))
    return _rounded(boxes, "q1", "median", "q3", "whisker_lo", "whisker_hi", digits=4)


_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(
    LONG
    + f"""SELECT Route, prob, count(*) AS n, true AS within
  FROM frame, (SELECT unnest([{', '.join(str(p) for p in _PROBS)}])) p(prob)
  WHERE CAST(full_date AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1998-02-28' GROUP BY ALL"""
)
def sketch_quantiles(spark, d):
    """Whether ranks of estimates from merged daily sketches are as near as stated, over two years.

    Days of 1997 are stored with half their rows first, then restated.
    """
    path = scratch_path(spark, "sketches")
    frame = data.long_frame(spark, d)
    wrong = frame.where((F.year("full_date") != 1997) | (F.hour("full_date") < 12))
    sketches.write_sketches(sketches.daily_sketches(wrong), path)
    sketches.write_sketches(sketches.daily_sketches(frame.where(F.year("full_date") == 1997)), path)
    window = ("1996-03-01", "1998-02-28")
    estimates = sketches.window_quantiles(sketches.read_sketches(spark, path), _PROBS, start=window[0], end=window[1])
    off = sketches.rank_errors(frames.filter_dates(frame, *window), estimates, _PROBS, "Price", ["Route"])
    return off.select("Route", "prob", "n", (F.col("off") <= 2 * sketches.rank_error()).alias("within"))


@query(ORACLE["density"])
def fast_density(spark, d):
    curve = density.fast_density(data.long_frame(spark, d))
    return curve.select(_r("x"), _r("density", 8))


# --------------------------------------------------------------------------- neighbours in one long key


@query(
    _with(LONG_WEEKLY, HOURLY)
    + """SELECT "Date", Route, round(Price, 4) AS Price,
    round(lag(Price) OVER w, 4) AS price_before, lead("Date") OVER w AS date_after,
    round(last_value(CASE WHEN dayofweek("Date") = 1 AND hour("Date") = 9 THEN Price END IGNORE NULLS)
      OVER (PARTITION BY Route ORDER BY "Date" ROWS UNBOUNDED PRECEDING), 4) AS monday_price
  FROM hourly WINDOW w AS (PARTITION BY Route ORDER BY "Date")"""
)
def neighbour_prices(spark, d):
    """Each price with the one before, the time of the next, and the last one set on a Monday at nine."""
    monday = (F.dayofweek("Date") == 2) & (F.hour("Date") == 9)
    prices = data.long_hourly(spark, d).withColumn("_set", F.when(monday, F.col("Price")))
    met = ordering.neighbours(prices, ["Route"], ["Date"], ["Date", "Price"], carried={"monday_price": "_set"})
    met = met.select(
        "Date", "Route", "Price", F.col("before.Price").alias("price_before"), F.col("after.Date").alias("date_after"), "monday_price"
    )
    return _rounded(met, "Price", "price_before", "monday_price", digits=4)


@query(ORACLE["hourly_rates_nulls"])
def hourly_rates_spread(spark, d):
    """Upsampling with anchors of a route dealt over range partitions."""
    holed = data.long_weekly(spark, d).withColumn(
        "Price", F.when(~F.month("Date").isin(1, 4, 7, 8, 12), F.col("Price"))
    )
    return _rounded(upsample.upsample_linear(holed, spread=True), "Price", digits=4)


@query(
    LONG_DAILY.rstrip() + "," + RETURNS
    + """ SELECT Route, CAST(day AS VARCHAR) AS day, close_price, round(daily_return, 8) AS daily_return FROM returns"""
)
def returns_spread(spark, d):
    daily = series.to_daily(data.long_frame(spark, d), ["Route"])
    found = series.daily_returns(daily, ["Route"], spread=True)
    return found.select("Route", _text("day"), "close_price", _r("daily_return", 8))


# --------------------------------------------------------------------------- phrases

_PHRASES = r"""
benchmark_words AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT array_to_string(w[i:i + 2], ' ') AS phrase
  FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM benchmark_words)),
cut AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\p{L}\p{N}]') AS t FROM documents),
grams AS (
  SELECT doc_id, array_to_string(t[i:i + 4], '') AS phrase FROM (SELECT doc_id, t, unnest(range(1, len(t) - 3)) AS i FROM cut)),
hits AS (SELECT doc_id, phrase, count(*) AS n FROM grams JOIN phrases USING (phrase) GROUP BY ALL)"""


def _benchmark_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Every three words in a row of the benchmark texts."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    cut = data.table(spark, d, "benchmark").select(words.alias("w")).where(F.size("w") > 2)
    return cut.select("w", F.explode(F.sequence(F.lit(1), F.size("w") - 2)).alias("i")).select(
        F.concat_ws(" ", F.slice("w", F.col("i"), F.lit(3))).alias("phrase")
    )


@query(_with(_PHRASES) + "SELECT doc_id, phrase, n FROM hits")
def phrase_hits(spark, d):
    return phrases.find_phrases(data.table(spark, d, "documents"), _benchmark_phrases(spark, d))


@query(
    _with(_PHRASES, _WORDS)
    + """SELECT doc_id, round(Tone, 6) AS Tone FROM tones WHERE Tone < 0.2 AND doc_id IN (SELECT doc_id FROM hits)"""
)
def match_phrases(spark, d):
    docs = with_lexicon_tone(data.table(spark, d, "documents"), POSITIVE, NEGATIVE)
    kept = phrases.match_phrases(docs, _benchmark_phrases(spark, d), max_tone=0.2)
    return _rounded(kept.select("doc_id", "Tone"), "Tone")


# --------------------------------------------------------------------------- footers


@query(
    _with(LONG_NEWS)
    + """SELECT CAST(strftime(e, '%Y%m') AS INTEGER) AS event_month, CAST(min(e) AS VARCHAR) AS min_event_date,
    CAST(max(e) AS VARCHAR) AS max_event_date, min(GlobalEventID) AS "min_GlobalEventID",
    max(GlobalEventID) AS "max_GlobalEventID", count(*) AS n
  FROM (SELECT *, CAST(try_strptime(day_s, '%Y%m%d') AS DATE) AS e FROM news) GROUP BY 1"""
)
def footer_months(spark, d):
    """Bounds and counts of each stored month of news, from its files' footers."""
    path = scratch_path(spark, "footer-news")
    write_news(data.long_news(spark, d), path)
    found = footer_bounds(spark, path, ["event_date", "GlobalEventID"], schemas.STORED_NEWS, by=["event_month"])
    return _dates_as_text(found, "min_event_date", "max_event_date")


@query(
    _with(SHORT_NEWS)
    + """SELECT CAST(greatest(DATE '2024-01-05', min(e)) AS VARCHAR) AS start_date,
    CAST(least(DATE '2024-02-28', max(e)) AS VARCHAR) AS end_date, count(*) AS n
  FROM (SELECT CAST(try_strptime(day_s, '%Y%m%d') AS DATE) AS e FROM news)"""
)
def footer_window(spark, d):
    """The window a date picker shows, clamped to the stored news without reading them."""
    path = scratch_path(spark, "footer-news")
    write_news(data.short_news(spark, d), path)
    found = footer_bounds(spark, path, ["event_date"], schemas.STORED_NEWS)
    return found.select(
        F.greatest(F.lit("2024-01-05").cast("date"), F.col("min_event_date")).cast("string").alias("start_date"),
        F.least(F.lit("2024-02-28").cast("date"), F.col("max_event_date")).cast("string").alias("end_date"),
        "n",
    )


# --------------------------------------------------------------------------- versioned tables


@query(
    SHORT
    + """, half AS (SELECT * FROM frame WHERE full_date < TIMESTAMP '2024-01-15 00:00:00'),
  rest AS (SELECT * FROM frame WHERE full_date >= TIMESTAMP '2024-01-15 00:00:00'),
  versions AS (SELECT 1 AS version, 'replace' AS operation, count(*) AS rows, count(*) AS total_rows, round(sum(Price), 4) AS price FROM half
  UNION ALL SELECT 2, 'append', (SELECT count(*) FROM rest), (SELECT count(*) FROM frame), (SELECT round(sum(Price), 4) FROM frame)
  UNION ALL SELECT 3, 'replace', (SELECT count(*) FROM rest), (SELECT count(*) FROM rest), (SELECT round(sum(Price), 4) FROM rest))
  SELECT CAST(version AS BIGINT) AS version, operation, rows, total_rows, price FROM versions"""
)
def snapshot_versions(spark, d):
    """Gold replaced, appended to (twice, as a job that runs again would), replaced, and not replaced by nothing."""
    table = SnapshotTable(spark, scratch_path(spark, "snapshots"), schemas.GOLD)
    frame = data.short_frame(spark, d)
    half, rest = frame.where("full_date < '2024-01-15'"), frame.where("full_date >= '2024-01-15'")
    table.replace(half)
    table.append(rest, batch="rest")
    table.append(rest, batch="rest")
    table.replace(rest)
    table.replace(rest.limit(0), skip_empty=True)
    sums = None
    for version in range(1, table.version() + 1):
        price = table.read(version).agg(F.round(F.sum("Price"), 4).alias("price")).withColumn("version", F.lit(version).cast("long"))
        sums = price if sums is None else sums.unionByName(price)
    return table.history().select("version", "operation", "rows", "total_rows").join(sums, "version")


# --------------------------------------------------------------------------- exports, ids, streams


@query(ORACLE["clean_news"])
def clean_news_by_line(spark, d):
    """Raw exports in one plan: each line parsed by its own file's header."""
    raw = read_exports_by_line(spark, _write_exports(spark, d))
    return _rounded(cleaning.clean_news(raw), "Tone")


#: Which events come in which of three batches.
_BATCHES = ("event_type = 'view'", "event_type IN ('click', 'error')", "event_type NOT IN ('view', 'click', 'error')")

_BATCH_CASE = f"CASE WHEN {_BATCHES[0]} THEN 0 WHEN {_BATCHES[1]} THEN 1 ELSE 2 END"


@query(
    f"""WITH read AS (
    SELECT *, {_BATCH_CASE} AS batch, strftime(ts, '%Y%m%d') AS day_s, event_type || '/' || CAST(user_id AS VARCHAR) AS url
    FROM events)
  SELECT 99999 + row_number() OVER (ORDER BY batch, day_s, url, -value / pi()) AS GlobalEventID, day_s AS "Day",
         '{fixed.COUNTRY}' AS Country, round(-value / pi(), 6) AS Tone, url AS SourceURL
  FROM read WHERE event_type <> 'signup'"""
)
def stream_ingest(spark, d):
    """Exports that arrive in three batches; ids carry on, and a batch that runs again changes nothing.

    Signups come without a url and are rejected.
    """
    return _ingested(spark, d)[0]


@query(
    f"""SELECT 'stream-' || {_BATCH_CASE} AS batch, count(*) AS n_lines, count(*) FILTER (event_type = 'signup') AS n_rejects
  FROM events GROUP BY 1"""
)
def stream_ingest_files(spark, d):
    """Lines and rejects by batch, from the ledger of files done and the stored rejects."""
    _, store = _ingested(spark, d)
    files = store.files.read().groupBy("batch").agg(F.sum("n_lines").alias("n_lines"))
    rejects = store.rejects.read().join(store.files.read().select("file_path", "batch"), "file_path")
    counted = rejects.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rejects"))
    return files.join(counted, "batch", "left").select("batch", "n_lines", F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"))


def _ingested(spark: SparkSession, d: str) -> tuple[DataFrame, ExportStore]:
    base = scratch_path(spark, "ingest")
    events = data.table(spark, d, "events").select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'").alias("Date"),
        (-F.col("value") / F.pi()).cast("string").alias("Tone"),
        F.when(F.col("event_type") != "signup", F.concat_ws("/", "event_type", F.col("user_id").cast("string"))).alias("URL"),
    )
    order = (["URL", "Date", "Tone"], ["Date", "Tone", "URL"], ["Tone", "URL", "Date"])
    for i, (chosen, columns) in enumerate(zip(_BATCHES, order)):
        events.where(chosen).select(*columns).write.csv(f"{base}/in/{i}", header=True)
        stream_exports(export_stream(spark, f"{base}/in/*"), f"{base}/store", f"{base}/checkpoint").awaitTermination()
    store = ExportStore(spark, f"{base}/store")
    again = spark.read.text(f"{base}/in/2").selectExpr(
        "value", "_metadata.file_path as file_path", "_metadata.file_block_start = 0 as opening"
    )
    store.add(again, "stream-2")
    return _rounded(store.news.read(), "Tone"), store


_LATE_MARK = "(SELECT max(ts) - INTERVAL 2 DAY FROM events WHERE user_id % 10 <> 0)"


@query(
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS news_count,
    round(avg(value / pi()), 6) AS avg_conflict_score,
    CAST(count(*) FILTER (user_id % 10 = 0 AND ts < {_LATE_MARK}) AS BIGINT) AS late_count
  FROM events GROUP BY 1"""
)
def late_days(spark, d):
    """Days restated by articles of some users, which all come last."""
    base, _ = _with_late(spark, d)
    return _dates_as_text(_rounded(restated_days(spark, base), "avg_conflict_score"), "event_date")


@query(
    f"""SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events WHERE user_id % 10 = 0 AND ts < {_LATE_MARK}"""
)
def late_articles(spark, d):
    """The articles that were set aside."""
    base, schema = _with_late(spark, d)
    return late_table(spark, base, schema).read().select("event_id", "ts")


def _with_late(spark: SparkSession, d: str) -> tuple[str, T.StructType]:
    base = scratch_path(spark, "late")
    events = data.table(spark, d, "events")
    chosen = ("user_id % 10 <> 0 and ts < '2024-01-20'", "user_id % 10 <> 0 and ts >= '2024-01-20'", "user_id % 10 = 0")
    for i, batch in enumerate(chosen):
        articles = events.where(batch).select("event_id", "ts", (-F.col("value") / F.pi()).alias("Tone"))
        articles.write.parquet(f"{base}/in/{i}")
        stream = spark.readStream.schema(articles.schema).parquet(f"{base}/in/*")
        stream_restated(stream, f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return f"{base}/store", articles.schema

