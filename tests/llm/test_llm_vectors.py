import math

import numpy as np
import pytest

from llm_cases import SF_SMALL
from llm.embedding_dedup import near_vectors
from llm.exact_topk import exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, key string, n long, block int"


def _planted():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    near = base[:20] + rng.normal(scale=0.08, size=(20, 16))
    chain = [np.cos(t) * base[0] / np.linalg.norm(base[0]) + np.sin(t) * np.eye(16)[3] for t in np.arange(0, 2, 0.4)]
    return np.concatenate([base, near, chain, base[5:8], 3 * base[5:8]]).astype(np.float32)


def _rows(x):
    return [(i, v.tolist(), 0, "k", 1, 2) for i, v in enumerate(x)]


def _links(x):
    x = x.astype(np.float64)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[s[i]]]) for i in range(len(x))])
        if (new == label).all():
            return s.sum(1), label
        label = new


def test_near_vectors_against_all_pairs(spark):
    x = _planted()
    got = near_vectors(spark.createDataFrame(_rows(x), SCHEMA)).toPandas().sort_values("vec_id")
    n, label = _links(x)
    assert got.n_links.tolist() == n.tolist() and got.component_id.tolist() == label.tolist()
    assert got.kept.tolist() == (label == np.arange(len(x))).tolist()


def test_near_vectors_odd_rows(spark):
    nan, one = float("nan"), [1.0] + [0.0] * 3
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [nan, 1.0, 0.0, 0.0]), (6, [math.inf, 1.0, 0.0, 0.0]),
        (7, one), (7, one), (8, one), (None, one), (9, [1.0, 0.0]), (10, [1e30, 0.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(a, b, None, "k", 1, 2) for a, b in rows], SCHEMA)
    got = sorted(map(tuple, near_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)]
    assert got == sorted([*alone, *[(7, 3, 7, True)] * 2, (8, 3, 7, False), (10, 3, 7, False), (None, 0, None, False)], key=str)
    assert near_vectors(df.limit(0)).count() == 0


def _best(ids, x, q, k):
    v = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    out = []
    for i in q:
        score = v @ v[ids.index(i)]
        ranked = sorted((-s, j) for j, s in zip(ids, score.tolist()) if j != i)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(ranked[:k], 1)]
    return sorted(out)


def test_topk_against_all_pairs_with_ties(spark):
    x = np.round(_planted() * 2) / 2
    df = spark.createDataFrame(_rows(x), SCHEMA)
    got = sorted(map(tuple, exact_topk(df, df.where("vec_id % 10 = 0"), k=7).collect()))
    assert got == _best(list(range(len(x))), x, range(0, len(x), 10), 7)


def test_topk_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, [-0.0005, 0.0]), (None, [1.0, 1.0]), (6, [1e9, 1.0]), (100, [])]
    df = spark.createDataFrame([(a, b, None, "k", 1, 2) for a, b in rows], SCHEMA)
    got = sorted(map(tuple, exact_topk(df, df.where("vec_id % 100 = 0")).collect()))
    # The query 0 is its smaller vector, (512, 0); -0.0005 rounds down to -1.
    assert got == [(0, 1, 6, 512 * 1024 * 10**9), (0, 2, 5, -512)]
    assert exact_topk(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op3_ngram_jaccard_join", "op4_exact_topk"])
def test_queries_agree_with_sql(spark, name):
    from llm.queries import ORACLE, QUERIES
    from oracle import compare

    assert compare(spark, SF_SMALL, name, QUERIES, ORACLE) is None
