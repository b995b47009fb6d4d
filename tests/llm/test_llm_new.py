"""Alignment, best-fit packing and whitening against plain versions."""

import hashlib
import zlib
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest

from llm_cases import SF_SMALL, docs_schema, no_docs, odd_docs  # noqa: F401
from llm.best_fit import lay_out, pack_best_fit, patterns
from llm.encoders import resolve, token_bytes
from llm.queries import QUERIES
from llm.token_alignment import align_tokenizers, common_cuts
from llm.whitening import eigenpairs, whiten

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
DIGESTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(resolve(A))
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=resolve(B))


# --------------------------------------------------------------------------- alignment


def _walked(text, library):
    """Groups and links of one text, token by token."""
    one, two = library
    a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
    parts_a, parts_b = [token_bytes(A)[i] for i in a], [token_bytes(B)[i] for i in b]
    if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
        return None
    i = j = at_a = at_b = 0
    groups, links, own_a, own_b = [], [], [], []
    while i < len(a):
        links.append((a[i], b[j]))
        own_a += [i] * (i not in own_a)
        own_b += [j] * (j not in own_b)
        end_a, end_b = at_a + len(parts_a[i]), at_b + len(parts_b[j])
        if end_a == end_b:
            groups.append(",".join(str(a[x]) for x in own_a) + "|" + ",".join(str(b[x]) for x in own_b))
            own_a, own_b = [], []
        if end_a <= end_b:
            i, at_a = i + 1, end_a
        if end_b <= end_a:
            j, at_b = j + 1, end_b
    return a, b, groups, links


def _expected(rows, library):
    walked = [_walked(r.text, library) if r.text else None for r in rows]
    held, best = Counter(), defaultdict(int)
    for w in walked:
        held.update(set(w[3]) if w else ())
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for r, w in zip(rows, walked):
        if w is None:
            out.append((r.doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = w
        top, total = sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((r.doc_id, len(a), len(b), len(groups), len(links), top, total, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1_000_000, 40, 0])
def test_alignment_against_a_walk(spark, odd_docs, library, hot):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).select("doc_id", "text")
    tricky = [
        (900, "<s> a </s> <|endoftext|> <0x41>"), (901, "a ▁ piece sign"), (902, "  two  spaces\n\n\t"), (903, "=" * 300),
        (904, "漢字かな交じり文 😀😀 Ünïcödé ﬁ"), (905, "\x00 control \x01"), (906, "a"), (906, "a"), (907, "0123456789" * 40),
    ]
    docs = docs.union(spark.createDataFrame(tricky, "doc_id long, text string")).union(odd_docs.select("doc_id", "text"))
    docs = docs.withColumn("n_a", docs.doc_id).withColumn("row", docs.doc_id)
    got = align_tokenizers(docs, outputs=("groups_sha256",), hot=hot).select(*DIGESTS)
    rows = docs.collect()
    want = _expected(rows, library)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert (901, 0, 0, 0, 0, 0, 0, "") in want and sum(w[1] > 0 for w in want) > 60


def test_alignment_outputs(spark, no_docs, library):
    docs = spark.createDataFrame([(1, "Some tokenizations differ."), (2, None)], "doc_id long, text string")
    one, none = align_tokenizers(docs, outputs=("groups", "a_ids", "b_ids", "a_cuts", "b_cuts")).orderBy("doc_id").collect()
    a, b, groups, _ = _walked("Some tokenizations differ.", library)
    assert one.groups == ";".join(groups)
    assert np.frombuffer(one.a_ids, "<u4").tolist() == a and np.frombuffer(one.b_ids, "<u4").tolist() == b
    cuts = zip(np.frombuffer(one.a_cuts, "<u4"), np.frombuffer(one.b_cuts, "<u4"))
    sizes = [(g.split("|")[0].count(",") + 1, g.split("|")[1].count(",") + 1) for g in groups]
    assert list(cuts) == list(zip(np.cumsum([x for x, _ in sizes]), np.cumsum([y for _, y in sizes])))
    assert (none.groups, none.a_ids, none.b_cuts) == ("", b"", b"")
    assert align_tokenizers(no_docs).count() == 0
    with pytest.raises(ValueError):
        align_tokenizers(docs, tokenizer_a=B)


def test_common_cuts_on_random_ends():
    rng = np.random.default_rng(5)
    for n, share in ((1, 1.0), (50, 0.3), (400, 0.0), (3000, 0.01), (3000, 0.9)):
        spans, all_a, all_b, base = [], [], [], 0
        for _ in range(3):
            cells = np.arange(1, 4 * n + 1)
            both = cells[rng.random(len(cells)) < share]
            a = np.unique(np.concatenate([both, cells[::4], [4 * n]]))
            b = np.setdiff1d(np.unique(np.concatenate([both, cells[2::4], [4 * n]])), np.setdiff1d(a, np.append(both, 4 * n)))
            spans.append((len(all_a), len(all_a) + len(a), len(all_b), len(all_b) + len(b)))
            all_a, all_b, base = [*all_a, *(a + base)], [*all_b, *(b + base)], base + 4 * n
        a, b = np.array(all_a), np.array(all_b)
        groups = common_cuts(a, b, np.array(spans))
        shared = np.intersect1d(a, b)
        assert (a[groups[:, 1] - 1] == shared).all() and (b[groups[:, 3] - 1] == shared).all()
        assert (groups[1:, 0] == groups[:-1, 1]).all() and (groups[1:, 2] == groups[:-1, 3]).all()


# --------------------------------------------------------------------------- best-fit packing


def _check_packing(docs, got, plain, window):
    from llm.encoders import encoder

    rows = got.collect()
    sequences, owned = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        owned[r.doc_id].append(r)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= window
    assert sorted(sequences) == list(range(len(sequences)))
    total = 0
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(np.append(encoder(A).ids(r.text), 0).astype("<u4"))
    for doc, copies in texts.items():
        want = Counter()
        for ids in copies:
            total += len(ids)
            first = len(ids) % window or window
            cuts = [0, *range(first, len(ids) + 1, window)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[(i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in owned[doc]) == want
    return len(sequences), total


@pytest.mark.parametrize("window", [2048, 64, 7, 1])
def test_packing_round_trip(spark, odd_docs, no_docs, window):
    got = pack_best_fit(odd_docs.withColumn("part", odd_docs.n), window=window)
    assert "ids" in got.columns and "ids" not in pack_best_fit(odd_docs, keep_ids=False).columns
    for r in got.collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    n, total = _check_packing(odd_docs, got, None, window)
    assert n >= -(-total // window)
    assert pack_best_fit(no_docs).count() == 0


def test_packing_is_near_the_least_number_of_sequences(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    n, total = _check_packing(docs, QUERIES["op12_best_fit_packing"](spark, SF_SMALL.replace("0.001", "0.01")), None, 2048)
    assert n <= 1.01 * -(-total // 2048) + 1


def test_packing_spreads_a_hot_length(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'copy of one text', repeat('word ', id % 97)) as text")
    n, total = _check_packing(docs.repartition(13), pack_best_fit(docs.repartition(13), window=100), None, 100)
    assert n <= 1.02 * -(-total // 100)


def _least_windows(lengths, window):
    """Best-fit decreasing, item by item."""
    open_ = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in open_ if g >= x]
        if fits:
            gap = min(fits)
            open_.remove(gap)
            open_.append(gap - x)
        else:
            open_.append(window - x)
    return len(open_)


def test_patterns_use_all_and_beat_plain_best_fit():
    rng = np.random.default_rng(8)
    for draw in range(40):
        window = int(rng.integers(1, 60))
        lengths = rng.integers(1, window + 1, int(rng.integers(0, 400)))
        counts = np.bincount(lengths, minlength=window + 1)
        found = patterns(counts)
        used = np.zeros(window + 1, int)
        for need, times in found:
            assert times > 0 and sum(x * n for x, n in need.items()) <= window
            for x, n in need.items():
                used[x] += n * times
        assert (used == counts).all()
        assert sum(t for _, t in found) <= _least_windows(lengths.tolist(), window) + 1
    rows = lay_out(patterns(np.array([0, 2, 0, 0, 2])))  # lengths 1 and 4 in windows of 4
    assert [(r[0], r[1], r[2]) for r in rows] == [(4, 0, 2), (1, 0, 2)]


def test_a_triple_fills_what_pairs_cannot():
    assert patterns(np.bincount([10, 2, 3, 5, 9], minlength=21))[0][0] in ({10: 1, 2: 1, 3: 1, 5: 1}, {10: 1, 9: 1})
    assert patterns(np.bincount([10, 2, 3, 5], minlength=21)) == [({10: 1, 5: 1, 3: 1, 2: 1}, 1)]


# --------------------------------------------------------------------------- whitening


SCHEMA = "vec_id long, embedding array<float>, label int, x binary, n long, dim int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, None, None, 1, 2) for i, v in rows], SCHEMA)


def _against_dense(got, ids, vectors, k=8):
    x = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(0)
    y = (n * x - sums) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    got = got.sort_values(["component", "vec_id"])
    assert (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    exact = dict(zip(ids, ((n * x - sums) ** 2).sum(1).tolist()))
    assert all(Decimal(exact[i]) == d for i, d in zip(got.vec_id, got.deviation))
    for j, part in got.groupby("component"):
        z = part.whitened.to_numpy()
        want = (y @ u[:, j - 1] / np.sqrt(e[j - 1]))[np.argsort(ids)]
        want *= np.sign(want @ z)
        assert np.abs(z - want).max() < 1e-7
        assert abs(part.explained.iloc[0] - e[j - 1] / np.trace(v)) < 1e-12
    return len(got)


@pytest.mark.parametrize("dim, rows", [(64, 400), (90, 300), (5, 40), (1, 9)])
def test_whitening_against_a_dense_solver(spark, dim, rows):
    rng = np.random.default_rng(dim)
    vectors = (rng.normal(size=(rows, dim)) @ rng.normal(size=(dim, dim)) + 40).astype(np.float32)
    got = whiten(_table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])).toPandas()
    assert _against_dense(got, list(range(rows)), vectors) == rows * min(dim, 8)


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [[1.0, 2.0, 0.5], [0.0, -2.0, 1.5], [3.0, 1.0, 1.0], [-1.0, 0.25, 1.0], [3.0, 1.0, 1.0]]
    ids = [7, None, 3, 4, 4]
    bad = [(10, None), (11, []), (12, [1.0, None, 2.0]), (13, [1.0, nan, 2.0]), (14, [inf, 1.0, 2.0]), (15, [1.0, 2.0])]
    got = whiten(_table(spark, [*zip(ids, good), *bad])).toPandas()
    assert len(got) == 15 and got.vec_id.isna().sum() == 3 and set(got.vec_id.dropna()) == {3, 4, 7}
    assert got.identity_error.max() < 1e-12 and abs(got[["component", "explained"]].drop_duplicates().explained.sum() - 1) < 1e-12
    flat = whiten(_table(spark, [(i, [1.0, 2.0, float(i)]) for i in range(4)])).toPandas()
    assert set(flat.component) == {1} and (flat.explained == 1).all()
    assert whiten(_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten(_table(spark, bad[:2])).count() == 0
    assert whiten(_table(spark, [])).columns == list(got.columns)
    with pytest.raises(Exception, match="too large"):
        whiten(_table(spark, [(1, [1e30]), (2, [1.0])])).count()


def test_whitening_deviations_beyond_a_long(spark):
    big = [2.0**41, -(2.0**41), 0.0, 2.0**40]
    got = whiten(_table(spark, [(i, [b]) for i, b in enumerate(big)])).toPandas().sort_values("vec_id")
    x = [int(1024 * b) + 100000 for b in big]
    assert [int(d) for d in got.deviation] == [(4 * v - sum(x)) ** 2 for v in x]


def test_whitening_query(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = QUERIES["op13_embedding_whitening"](spark, sf).toPandas()
    got["deviation"] = got.deviation.map(Decimal)
    assert _against_dense(got, table.vec_id.tolist(), np.stack(table.embedding)) == 8 * len(table)


def test_eigenpairs_of_hard_spectra():
    rng = np.random.default_rng(2)
    spectra = {
        "equal": np.r_[[50.0] * 5, [40.0] * 6, np.ones(189)],
        "few": np.r_[[5.0, 4.0, 3.0], np.zeros(61)],
        "close": 100 + np.linspace(1, 0, 300),
        "steep": 2.0 ** -np.arange(150),
        "flat": np.full(64, 3.0),
    }
    for name, values in spectra.items():
        q, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
        v = q * values @ q.T
        v = (v + v.T) / 2
        e, u = eigenpairs(lambda x: v @ x, len(values), 8)
        assert np.abs(e - values[:8]).max() < 1e-13 * values[0], name
        assert np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-12 * values[0], name
        assert np.abs(u.T @ u - np.eye(8)).max() < 1e-12, name
