import random
import re

import numpy as np
import pytest

from llm_cases import docs_schema, no_docs, odd_docs  # noqa: F401
from llm import jaccard_join, substring_dedup
from llm.jaccard_join import jaccard_components, keep_first
from llm.substring_dedup import align, chain, drop_passages, find_passages


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def _set(text):
    w = _words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows):
    sets = [(i, _set(t)) for i, t in rows]
    label = {i: i for i, _ in sets}
    changed = True
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and 100 * len(x & y) >= 80 * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((i, len(s), label[i]) for i, s in sets)


def _corpus(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    rows, base = [], [[rng.choice(vocab) for _ in range(rng.choice([3, 5, 40, 120, 200]))] for _ in range(12)]
    common = [rng.choice(vocab) for _ in range(60)]
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        if rng.random() < 0.3:
            words += common
        rows.append((i, " ".join(words).upper() if rng.random() < 0.2 else "\n ".join(words)))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_jaccard_against_all_pairs(spark, monkeypatch, hot):
    rows = _corpus(1)
    if hot:  # common shingles go the way of the last tier, and blocks are small
        monkeypatch.setattr(jaccard_join, "HOT_BLOCK", 1)
        monkeypatch.setattr(jaccard_join, "TILE", 4)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_jaccard_without_stars_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "STARS", 1)
    rows = _corpus(2)
    assert sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == _brute(rows)


def test_jaccard_at_the_threshold(spark):
    one = [f"a{i}" for i in range(13)]  # 9 shingles
    two = [*one[:-1], "b"]  # shares 8 of 9: 8 / 10
    three = [*one[:12], "c", "d"]  # 8 common, 9 and 10: 8 / 11
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(three)), (4, "a b"), (5, "A  b"), (6, "a b c")]
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    got = sorted(map(tuple, jaccard_components(odd_docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (None, 2, None), (5, 1, 5), (6, 1, 6), (7, 1, 7)], key=str)
    assert jaccard_components(no_docs).count() == 0
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 9


def _passage(rng, n):
    return [f"p{rng.randrange(10**6)}" for _ in range(n)]


def test_passages_planted_and_clean(spark):
    rng = random.Random(5)
    exact, fuzzy, hot, short = (_passage(rng, n) for n in (60, 90, 55, 30))
    changed = list(fuzzy)
    changed[30], changed[60] = "x", "y"
    del changed[45]
    rows = [[i, _passage(rng, 200)] for i in range(40)]
    rows[3][1][50:50], rows[9][1][120:120] = exact, exact
    rows[4][1][0:0], rows[20][1][200:] = fuzzy, changed
    for i in range(25, 35):
        rows[i][1][100:100] = hot
    rows[1][1][10:10] = short
    rows[2][1][70:70] = short
    rows[39][1] = list(rows[0][1])
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in find_passages(df).collect()}
    assert set(got) == {9, 20, 39, *range(26, 35)}
    assert (got[9].start_word, got[9].end_word, got[9].source_ids) == (120, 180, [3])
    assert (got[20].start_word, got[20].end_word, got[20].source_ids) == (200, 289, [4])
    assert got[20].matched == 87 and (got[39].n_words, got[39].matched) == (200, 200)
    assert all((got[i].start_word, got[i].end_word) == (100, 155) and got[i].source_ids == [25] for i in range(26, 35))
    left = {r.doc_id: r.text for r in drop_passages(df).collect()}
    assert 39 not in left and left[9] == " ".join(rows[9][1][:120] + rows[9][1][180:])
    assert left[20] == " ".join(rows[20][1][:200]) and left[0] == " ".join(rows[0][1]) and len(left) == 39


def test_passage_pieced_together_from_two_sources(spark):
    rng = random.Random(6)
    one, two = _passage(rng, 30), _passage(rng, 30)
    rows = [(1, _passage(rng, 50) + one), (2, two + _passage(rng, 50)), (3, _passage(rng, 20) + one + two)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    (row,) = find_passages(df).collect()
    assert (row.doc_id, row.start_word, row.end_word, row.source_ids) == (3, 20, 80, [1, 2])


def test_passages_odd_rows(spark, odd_docs, no_docs):
    assert find_passages(odd_docs).count() == 0 and find_passages(no_docs).count() == 0
    left = drop_passages(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r[:2]) for r in left.collect()) == sorted(str(r[:2]) for r in odd_docs.collect())


def test_chain_against_quadratic():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(2, 40))
        at = np.sort(rng.integers(0, 120, n))
        src = rng.integers(0, 120, n)
        score = np.ones(n)
        for i in range(n):
            for j in range(i):
                if at[j] < at[i] and src[j] < src[i]:
                    gain = score[j] - (at[i] - at[j] + src[i] - src[j]) / substring_dedup.REACH
                    if gain > 0:
                        score[i] = max(score[i], 1 + gain)
        found = chain(at, src)
        for x, y in found:
            assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
        if score.max() > 1:
            x, y = found[0]
            assert abs(len(x) - (x[-1] - x[0] + y[-1] - y[0]) / substring_dedup.REACH - score.max()) < 1e-9


def test_align_breaks_at_a_different_stretch():
    a = np.arange(120, dtype=np.uint64)
    b = np.concatenate([a[:40], np.arange(900, 940, dtype=np.uint64), a[80:]])
    assert align(a, b, np.array([5, 20, 90, 110]), np.array([5, 20, 90, 110])) == [(0, 40, 40), (80, 120, 40)]


def _drawn(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10**9, n)]


def _repeated(texts, min_words, margin):
    """Of each document the words covered by runs of `min_words` words or more that a smaller id's text holds too, less margins."""
    seen, out = {}, {}
    for doc in sorted(texts):
        words = texts[doc]
        grams = [" ".join(words[i : i + min_words]) for i in range(len(words) - min_words + 1)]
        out[doc] = {j for i, g in enumerate(grams) if g in seen for j in range(i + margin, i + min_words - margin)}
        for g in grams:
            seen.setdefault(g, doc)
    return out


def test_passages_made_of_phrases_that_many_texts_use(spark):
    rng = np.random.default_rng(12)
    shared = _drawn(rng, 80)
    texts = {500: _drawn(rng, 60) + shared + _drawn(rng, 30), 501: _drawn(rng, 20) + shared + _drawn(rng, 70)}
    for i in range(76):
        texts[i] = _drawn(rng, 30) + shared[i : i + 5] + _drawn(rng, 30)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    (row,) = find_passages(df).collect()
    assert (row.doc_id, row.start_word, row.end_word, row.matched) == (501, 20, 100, 80) and 500 in row.source_ids


def test_exact_repeats_are_all_found(spark):
    rng = np.random.default_rng(13)
    stock = [_drawn(rng, 150) for _ in range(8)]
    phrases = [_drawn(rng, 6) for _ in range(30)]
    texts = {}
    for doc in range(120):
        words = _drawn(rng, 40)
        for _ in range(3):
            source = stock[rng.integers(8)]
            a = int(rng.integers(0, 40))
            words += source[a : a + int(rng.integers(85, 110))] + phrases[rng.integers(30)] + _drawn(rng, 25)
        if doc % 4 == 0:  # parts of the stock in texts of their own come before or between
            a = int(rng.integers(0, 130))
            words = stock[doc % 8][a : a + 12] + words
        texts[doc] = words
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {}
    for r in find_passages(df).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
        assert r.source_ids == sorted(set(r.source_ids)) and max(r.source_ids) < r.doc_id
    # Up to SPACING - 1 words at either end hold no seed of their own.
    margin = substring_dedup.SPACING - 1
    want = _repeated(texts, 50 + 2 * margin, margin)
    assert sum(map(len, want.values())) > 5000
    for doc, places in want.items():
        assert places <= found.get(doc, set()), doc


def test_a_text_many_copy_from_is_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(14)
    shared = _drawn(rng, 70)
    rows = [(i, " ".join(_drawn(rng, 10 + i % 3) + shared + _drawn(rng, 20))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(str, find_passages(df).collect()))
    monkeypatch.setattr(substring_dedup, "RANGES", 4)
    assert sorted(map(str, find_passages(df).collect())) == plain and len(plain) == 59
