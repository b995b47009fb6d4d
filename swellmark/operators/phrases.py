"""Searching texts for many phrases at once.

A pattern of alternatives is tried at every place of every text and grows with the list.
Here phrases are a table. Texts and phrases are cut into words and the single signs
between them. Each phrase is filed under a run of a few of its pieces, the one that holds
its rarest word. The runs of texts meet that index in a join, which leaves few places;
there the text's pieces must spell the phrase. So the work per text follows its words,
whatever the number of phrases.

The phrases in pieces are written first. Their size is then known, and an index that fits a
broadcast is looked up text by text, without a shuffle of the texts' runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swellmark.session import written

#: A word, or one sign that belongs to no word.
PIECE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"

#: Pieces of a run: two words and what is between them.
RUN = 3

WORD = r"^[\p{L}\p{N}]+$"

SIGNS = r"[^\p{L}\p{N}]+"

#: Phrases that take at most so many bytes are broadcast, whatever the session's threshold.
INDEX_BYTES = 32 * 1024 * 1024


def pieces(text: Column | str) -> Column:
    """Lower-case words and the signs between them, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(PIECE), F.lit(0))


def _run(parts: Column | str, at: Column, size: int | Column) -> Column:
    """A number for `size` pieces, RUN at most, from `at` on (counted from 1).

    Pieces are named one by one: this is computed at every place of every text, where a slice would be a copy.
    """
    size = F.lit(size) if isinstance(size, int) else size
    return F.xxhash64(*[F.when(size > i, F.get(parts, at + (i - 1))) for i in range(RUN)], size)


def _cut(phrases: DataFrame, phrase: str) -> DataFrame:
    """`phrase`, `parts`, `size`: each distinct phrase that has a piece, with its pieces and those of its run."""
    cut = phrases.select(F.lower(phrase).alias("phrase")).where("phrase <> ''").distinct()
    return cut.withColumn("parts", pieces("phrase")).withColumn("size", F.least(F.size("parts"), F.lit(RUN)))


def phrase_index(
    phrases: DataFrame, docs: DataFrame, phrase: str = "phrase", text: str = "text", small: bool = False
) -> DataFrame:
    """`phrase`, `parts`, `run`, `size`, `at`: each distinct phrase with its pieces, and the number, size and place
    (from 1) of the run of RUN pieces, or of all if fewer, that holds its rarest word.

    Rare is what occurs in the fewest of `docs`; the first run is taken on a tie.
    Phrases without any piece are left out. `small` says that the phrases fit a broadcast.
    """
    return _filed(_cut(phrases, phrase), docs, text, small)


def _filed(cut: DataFrame, docs: DataFrame, text: str, small: bool) -> DataFrame:
    """`phrase_index` of phrases in pieces."""
    words = cut.select("phrase", F.posexplode("parts").alias("_pos", "word")).where(F.col("word").rlike(WORD))
    # An outer explode: a plain one adds a filter that cuts each text a second time.
    used = docs.select(F.explode_outer(F.array_distinct(F.split(F.lower(text), SIGNS))).alias("word"))
    if small:  # else all words are counted, so that counts are shuffled and not each text's words
        used = used.join(F.broadcast(words.select("word").distinct()), "word", "left_semi")
    counts = used.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_pos").alias("pos")))
    best = words.join(counts, "word", "left").groupBy("phrase").agg(rarest.alias("_best"))
    # The run starts at the word, or as far before it as the phrase's end demands; at 1 without a word.
    start = F.least(F.coalesce(F.col("_best.pos") + 1, F.lit(1)), F.size("parts") - F.col("size") + 1)
    placed = cut.join(best, "phrase", "left").withColumn("at", start)
    return placed.select("phrase", "parts", _run("parts", F.col("at"), F.col("size")).alias("run"), "size", "at")


def find_phrases(
    docs: DataFrame, phrases: DataFrame, key: str = "doc_id", text: str = "text", phrase: str = "phrase"
) -> DataFrame:
    """key, `phrase`, `n`: how often each phrase occurs in each text, where it does.

    Case does not matter, matches start and end at word borders, and signs stand for
    themselves, as in `match_news`; occurrences may overlap. Rows with one key are one text's parts.

    Texts are read twice: to count words, and to look runs up. Phrases of more than INDEX_BYTES
    meet the runs by a shuffle instead, and the texts with a place to look at are read once more.
    """
    cut = written(_cut(phrases, phrase), "phrases")
    held = F.octet_length("phrase") * 2 + F.size("parts") * 16 + 100
    sizes, total = cut.agg(F.collect_set("size"), F.sum(held)).first()  # RUN sizes at most
    if not sizes:
        return docs.select(key, F.lit("").alias("phrase"), F.lit(0).cast("long").alias("n")).limit(0)
    small = total <= INDEX_BYTES
    index = _filed(cut, docs, text, small)
    texts = docs.select(F.col(key).alias("_key"), pieces(text).alias("_all"))
    places = texts.select("_key", "_all", F.posexplode_outer("_all").alias("_pos", "_piece"))  # counted from 0
    runs = [_run("_all", F.col("_pos") + 1, size) for size in sorted(sizes)]
    seen = places.select("_key", "_all", "_pos", (runs[0] if len(runs) == 1 else F.explode(F.array(*runs))).alias("run"))
    first = F.col("_pos") - F.col("at") + 1  # where the phrase would start, counted from 0
    if small:
        met = seen.join(F.broadcast(index), "run").withColumn("first", first)
        found = met.where((F.col("first") >= 0) & _spelled(F.col("_all"), F.col("first"), F.col("parts")))
    else:
        found = _found_by_shuffle(texts, seen.drop("_all").join(index, "run").withColumn("first", first))
    return found.groupBy(F.col("_key").alias(key), "phrase").agg(F.count(F.lit(1)).alias("n"))


def _found_by_shuffle(texts: DataFrame, places: DataFrame) -> DataFrame:
    """`_key`, `phrase`, a row per occurrence: `places` brought to their texts, which are cut once more."""
    listed = places.where("first >= 0").select(F.col("_key").alias("_doc"), "first", "phrase", "parts").distinct()
    listed = listed.groupBy("_doc").agg(F.collect_list(F.struct("first", "phrase", "parts")).alias("_places"))
    met = texts.join(listed, texts["_key"].eqNullSafe(listed["_doc"]))
    hits = F.transform(F.filter("_places", lambda p: _spelled(F.col("_all"), p["first"], p["parts"])), lambda p: p["phrase"])
    return met.select("_key", F.explode(hits).alias("phrase"))


def _spelled(text: Column, first: Column, parts: Column) -> Column:
    """Whether the text's pieces from `first` on (counted from 0) are the phrase's, between borders."""
    behind = first + F.size(parts)
    same = F.slice(text, first + 1, F.size(parts)) == parts
    # Two words never touch, so only a phrase that starts or ends with a sign can touch a word.
    left = (first == 0) | F.get(parts, F.lit(0)).rlike(WORD) | ~F.get(text, first - 1).rlike(WORD)
    right = (behind >= F.size(text)) | F.get(parts, F.size(parts) - 1).rlike(WORD) | ~F.get(text, behind).rlike(WORD)
    return same & left & right


def match_phrases(
    docs: DataFrame,
    phrases: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrase: str = "phrase",
    max_tone: float | None = None,
    tone_col: str = "Tone",
) -> DataFrame:
    """Rows of `docs` whose text holds any of the phrases, with tone below the bound: `match_news` for a table of phrases.

    Tone is judged first and once, so texts it rules out are not searched; the others are written, since the
    search reads them again. `key` must identify a row.
    """
    kept = docs if max_tone is None else written(docs.where(F.col(tone_col) < max_tone), "phrase-texts")
    hits = find_phrases(kept, phrases, key, text, phrase).select(F.col(key).alias("_hit")).distinct()
    return kept.join(hits, kept[key].eqNullSafe(hits["_hit"]), "left_semi")
