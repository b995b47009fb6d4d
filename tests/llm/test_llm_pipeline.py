import re

import pandas as pd
import pytest

from llm_cases import SF, SF_SMALL, docs_schema, no_docs, odd_docs  # noqa: F401
import corpus_pipeline
from llm.mixing import mix_sources, mixed_copies


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes):
    """Level by level: who is above twice their size stops there, the excess goes to the rest."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, done = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in done]
        rest = total - sum(done.values())
        share = {s: rest * weights[s] / sum(weights[t] for t in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return done | share
        done |= {s: 2 * sizes[s] for s in over}


def test_targets_and_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mix_sources(docs).toPandas()
    text = docs.toPandas().set_index("doc_id").text
    assert (got["size"] == [_size(text[i]) for i in got.doc_id]).all()
    sizes = got.groupby("source")["size"].sum().to_dict()
    for source, target in _targets(sizes).items():
        rows = got[got.source == source]
        assert abs(rows.target - target).max() < 1e-6 * target and (rows.source_size == sizes[source]).all()
        assert abs(rows.taken.sum() - target) <= max(5, 0.005 * target)
    assert (got.taken <= 2 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    # Rates are twice a logistic function of lambda * size: log odds are in proportion to sizes.
    import numpy as np

    inner = got[(got.rate > 0.01) & (got.rate < 1.99) & (abs(got.rate - 1) > 1e-6)]
    slope = np.log(inner.rate / (2 - inner.rate)) / inner["size"]
    assert slope.groupby(inner.source).apply(lambda x: x.std() / abs(x.mean())).max() < 1e-6
    key = ["doc_id", "taken"]
    again = mix_sources(docs.repartition(7)).toPandas()
    pd.testing.assert_frame_equal(got[key].sort_values(key, ignore_index=True), again[key].sort_values(key, ignore_index=True))


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    got = mix_sources(odd_docs).toPandas()
    assert len(got) == 9 and (got.taken <= 2 * got["size"]).all()
    sizes = {k if isinstance(k, str) else None: v for k, v in got.groupby("source", dropna=False)["size"].sum().items()}
    want = _targets(sizes)
    assert all(abs(t - want[s if isinstance(s, str) else None]) < 1e-6 for s, t in zip(got.source, got.target))
    assert mix_sources(no_docs).count() == 0 and mixed_copies(no_docs).count() == 0
    assert mixed_copies(odd_docs).columns == odd_docs.columns
    empty = odd_docs.where("doc_id in (1, 2)")
    assert {(r.target, r.taken, r.copies) for r in mix_sources(empty).collect()} == {(0.0, 0, 1)}


def _by_cell(rows, number):
    out = {}
    for r, n in zip(rows, number):
        key = (r["source"], _size(r["text"]))
        out[key] = out.get(key, 0) + n
    return {k: n for k, n in out.items() if n}


@pytest.mark.parametrize("copies", [1, 2, 7, 40])
def test_copies_of_repeated_rows_are_dealt_row_by_row(spark, copies):
    rows = [(1, "one two three", "a")] * copies + [(2, "four five six", "a")] * 2 + [(None, "x y z", "a")] * copies
    rows += [(i, "word " * (1 + i % 5), "b") for i in range(10, 40)] + [(50, "a b c", "a"), (50, "d e f", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    drawn = mix_sources(docs).join(docs.select("doc_id", "text").distinct().dropDuplicates(["doc_id"]), "doc_id", "left").collect()
    want = {}
    for r in drawn:
        want[(r.source, r.size)] = want.get((r.source, r.size), 0) + r.copies
    got = mixed_copies(docs).collect()
    assert _by_cell([r.asDict() for r in got], [1] * len(got)) == {k: n for k, n in want.items() if n}
    # No row more than twice, and rows alike differ by one at most.
    for row in set(rows):
        n = sum((r.doc_id, r.text, r.source) == row for r in got)
        assert n <= 2 * rows.count(row)
    assert sorted(map(str, mixed_copies(docs).collect())) == sorted(map(str, got))


def test_stages_keep_columns_named_like_their_own(spark):
    names = ["_doc", "_gone", "_id", "_source", "_size", "_copy", "_copies", "_spans", "key", "size", "mark", "row", "more", "base", "edge",
             "left", "alike", "quota", "part", "seed", "node", "own", "cell_key_own"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(80)
    docs = docs.select("*", *[docs.doc_id.cast("string").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        left = docs.collect()
        assert left and all(r[n] == str(r.doc_id) for r in left for n in names), name


def test_stages_hand_on_all_columns(spark, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == frame.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == (0 if frame is no_docs else pytest.approx(20, abs=20))


def test_pipeline_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert set(pieces.doc_id) <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert (pieces.groupby("sequence_id").length.sum() <= 1024).all()
    # Tokens come near one and a half times those of the documents that are left.
    left = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, SF_SMALL)
    assert set(pieces.doc_id) <= {r.doc_id for r in left.select("doc_id").collect()}
    words = sum(_size(r.text) for r in left.collect())
    taken = mixed_copies(left).collect()
    assert abs(sum(_size(r.text) for r in taken) - 1.5 * words) < 0.02 * words
