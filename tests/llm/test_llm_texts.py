import zlib

import numpy as np
import pandas as pd
import pytest

from llm_cases import SF, SF_SMALL, SF_TENTH, docs_schema, no_docs, odd_docs  # noqa: F401
from llm import html_text, language_id, toxicity
from llm.encoders import encoder, resolve
from llm.html_text import extract_pages, page_text
from llm.packing import Levels, pack_documents
from llm.token_counts import count_tokens
from swellmark.session import scratch_path

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(resolve(NAME))


def test_encoder_agrees_with_the_library(spark, plain):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += ["", " ", "a\x85b\x1cc d　e", "a<|endoftext|>b", "x" * 30000, "!?" * 9000, "\n\n \t x  ", "naïve 漢字 ١٢ 😀‍", "I'll'S 'll"]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(1, 0x300)]
    own = encoder(NAME)
    assert own.fast is not None
    for text in texts:
        assert own.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    own = encoder(name)
    assert own.fast is None and len(own.ids("Some text, twice. Some text")) > 3 and len(own.ids(None)) == 0


def test_counts_and_cache(spark, odd_docs, no_docs, plain):
    cache = scratch_path(spark, "test-cache")
    first = sorted(map(tuple, count_tokens(odd_docs, cache, limit=3).collect()), key=str)
    want = []
    for r in odd_docs.collect():
        n = len(plain.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 3))
    assert first == sorted(want, key=str)
    stored = spark.read.parquet(cache).count()
    assert stored == len({r.text or "" for r in odd_docs.collect()})  # each content once
    assert sorted(map(tuple, count_tokens(odd_docs, cache, limit=3).collect()), key=str) == first
    assert spark.read.parquet(cache).count() == stored  # nothing encoded anew
    more = odd_docs.unionByName(odd_docs.limit(1).selectExpr("99L as doc_id", "'new' as text", "lang", "source", "n_chars", "token", "n"))
    assert count_tokens(more, cache).count() == 10 and spark.read.parquet(cache).count() == stored + 1
    count_tokens(more, cache, "piece_bpe_32k.model").count()
    assert spark.read.parquet(cache).count() > stored + 1  # another version, other counts
    assert count_tokens(no_docs, scratch_path(spark, "test-cache")).count() == 0


def _unpack(pieces: pd.DataFrame):
    """Round trip: every document's ids from its pieces; sequences without gaps."""
    for _, rows in pieces.sort_values("offset").groupby("sequence_id"):
        assert (rows.offset.to_numpy() == np.concatenate([[0], np.cumsum(rows.length)[:-1]])).all()
        assert rows.length.sum() <= 1024
    assert all(zlib.crc32(raw) == c and len(raw) == 4 * n for raw, c, n in zip(pieces.ids, pieces.ids_crc32, pieces.length))
    return {doc: (b"".join(rows.ids), rows.start.tolist(), rows.length.tolist()) for doc, rows in pieces.sort_values("start").groupby("doc_id")}


def test_packing_round_trip(spark, plain):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pieces = pack_documents(docs.repartition(3)).toPandas()
    found = _unpack(pieces)
    for r in docs.collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        raw, starts, lengths = found.pop(r.doc_id)
        assert raw == ids.tobytes() and starts == np.concatenate([[0], np.cumsum(lengths)[:-1]]).tolist()
    assert not found
    fills = pieces.groupby("sequence_id").length.sum()
    assert (fills < 1024).sum() <= 3  # at most one per task


def test_packing_odd_rows(spark, odd_docs, no_docs):
    pieces = pack_documents(odd_docs.coalesce(1)).toPandas()
    assert pieces[pieces.doc_id.isin([1, 2])][["length", "doc_tokens", "ids_crc32"]].drop_duplicates().values.tolist() == [[1, 1, zlib.crc32(bytes(4))]]
    assert pieces.doc_id.isna().sum() == 1 and (pieces.doc_id == 4).sum() > 2
    assert pack_documents(no_docs).count() == 0


def test_sum_of_squares_choice():
    levels = Levels(10)
    for size in (4, 4, 6):  # a second 4 beside the first costs more squares than on top of it
        full = levels.place((1, 0, np.zeros(size), size))
    assert full is None and levels.count.tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 1, 0, 0]
    assert len(levels.place((1, 0, np.zeros(2), 2))) == 3  # fills the eight
    assert [sum(len(p[2]) for p in w) for w in levels.close()] == [6]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 1000 and (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_against_plain_counts(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("abab", "x"), ("bbaa b", "x"), ("cdcd", "y"), ("dc d", "y"), ("Abc", None), ("ddd", "x")])]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    langs, table = model
    assert langs == ["x", "y"] and np.allclose(np.exp(table[-1]), [3 / 5, 2 / 5])
    import pyarrow as pa

    names, scores = language_id._scores(pa.array(["ABAB", "c1D", None, "12", "", "é"]), *model)
    assert names == ["x", "y", "und", "und", "und", "x"] and scores[2:5] == [0, 0, 0]

    def grams(text):
        text = "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        return [text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)]

    total = {g: sum((grams(t) for _, t, l in rows if l == g), []) for g in langs}
    logs = [np.log(sum(l == g for _, _, l in rows) / 5) + sum(np.log((total[g].count(s) + 0.5) / (len(total[g]) + 0.5 * language_id.FEATURES)) for s in grams("abab")) for g in langs]
    assert np.isclose(scores[0], 1 / np.exp(np.array(logs) - logs[0]).sum())


def test_language_odd_rows(spark, odd_docs, no_docs):
    got = language_id.identify(odd_docs).collect()
    assert len(got) == 9 and {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert language_id.identify(no_docs).count() == 0
    kept = language_id.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {4, None, 5, 6}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_TENTH}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    hits = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hits / (held.toxic == 1).sum() > 0.85 and hits / (held.predicted == 1).sum() > 0.85
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()


def test_toxicity_reads_texts_only_and_copes_with_odd_rows(spark, odd_docs, no_docs):
    rows = [(i, ("good calm day " * 9) + ("vile " if i % 2 else "kind ") + "end", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], None, r[2]) for r in rows] + [(None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all(got[i].predicted == i % 2 for i in range(60))
    assert len(toxicity.score_toxicity(odd_docs, labels).collect()) == 9
    assert {r.score for r in toxicity.score_toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(no_docs, labels).count() == 0


PAGES = "page_id long, url string, html string, host string, templates string"


def _page(title, body):
    return f"<html><body><div class=top><a href=/>Home</a> <a href=/x>All news</a></div><div>{body}</div><div>Made by hand &copy; us</div></body></html>"


def test_templates_of_a_host_go(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f"https://a.org/{i}", _page(i, f"<p>Own text {rng.integers(10**9)} of page {i}, long enough.</p><p>More of {i} here</p>"), "", "") for i in range(12)]
    rows += [(100 + i, f"https://b.org/{i}", _page(i, f"<p>Few pages {i}</p>"), "", "") for i in range(2)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i].split("\n")[0].startswith("Own text") and got[i].endswith(f"More of {i} here") for i in range(12))
    assert "Home All news" in got[100]  # two pages tell no template


def test_page_text_by_structure():
    page = (
        "<!DOCTYPE html><title>T</title><header><h1>Site</h1></header><nav>Menu</nav><main><article><header><h1>A &lt;b&gt; &amp; c</h1></header>"
        "<p>one\n <b>two</b><br>three<p>four&nbsp;&eacute;<script>var a = '</p>';</script><style>x{}</style><!-- <p>no</p> -->"
        "<ul><li>i<li>ii</ul><table><tr><td>x<td>y</table><div class='ad-box'>buy</div><form>f</form><aside>s</aside>"
        "<section id=comments><p>first!</p></section></article></main><div class='cookie-notice'>ok?</div><footer>f</footer>"
    )
    assert page_text(page) == "A <b> & c\none two three\nfour é\ni\nii\nx\ny"
    assert page_text(None) == page_text("") == page_text("<nav>m</nav>") == ""
    assert page_text("plain text &amp; more") == "plain text & more"
    assert page_text("<p>unclosed <i>tag") == "unclosed tag"


def test_pages_repeated_article_text_stays(spark):
    html = "<html><body><nav>m</nav><article><h1>Same</h1><p>Same text on all pages.</p></article></body></html>"
    rows = [(i, f"http://c.net/{i}", html, "", "") for i in range(20)]
    rows += [(50, None, None, None, None), (None, "nonsense", "", "", ""), (51, "http://c.net/z", "<p>" * 20000 + "deep", "", "")]
    df = spark.createDataFrame(rows, PAGES)
    got = extract_pages(df).collect()
    assert len(got) == 23 and all(r.text == "Same\nSame text on all pages." and r.n_chars == 28 for r in got if r.page_id is not None and r.page_id < 20)
    assert {r.text for r in got if r.page_id in (50, None)} == {""}
    assert extract_pages(df.limit(0)).count() == 0 and html_text.page_text(html)


def _plain_extract(pages):
    """Template removal by strings and per-host lists: [(host, xml)] of unmarked pages without classes that say anything."""
    import xml.etree.ElementTree as ET
    from collections import defaultdict

    blocks, kept = {"div", "section", "p", "table"}, {"p"}

    def words(node):
        return [w for w in ((node.text or "").strip(), *(x for c in node for x in (*words(c), (c.tail or "").strip()))) if w]

    def length(node):
        return sum(len(w) for w in words(node))

    def shape(node):
        return f"({node.tag}.{node.get('class')}{sorted({shape(c) for c in node})})"

    def content(node):
        return f"[{node.tag} {(node.text or '').strip()} {[content(c) for c in node]}]"

    def found(body, node, place=""):
        for child in node:
            same = [c for c in node if (c.tag, c.get("class")) == (child.tag, child.get("class"))]
            here = f"{place}/{child.tag}.{child.get('class')}"
            if child.tag in blocks and length(child) and 2 * length(child) <= length(body):
                yield child, content(child), None
                if child.tag not in kept and len(same) == 1:
                    yield child, here + shape(child), length(child)
            yield from found(body, child, here)

    hosts = defaultdict(dict)
    for host, source in pages:
        body = ET.fromstring(source)
        hosts[host][source] = (length(body), {k: n for _, k, n in found(body, body)})
    templates = {}
    for host, listed in hosts.items():
        for key in {k for _, keys in listed.values() for k in keys}:
            on = [(total, keys[key] or 0) for total, keys in listed.values() if key in keys]
            if len(on) >= 4 and len(on) >= 0.2 * len(listed) and 6 * sum(n for _, n in on) <= sum(t for t, _ in on):
                templates.setdefault(host, set()).add(key)
    texts = []
    for host, source in pages:
        body = ET.fromstring(source)
        gone = {id(c) for c, k, _ in found(body, body) if k in templates.get(host, ())}

        def lines(node):
            return [x for c in node if id(c) not in gone for x in ([c.text] if c.text else []) + lines(c)]

        texts.append("\n".join(lines(body)))
    return texts, templates


def test_templates_as_by_brute_force(spark):
    rng = np.random.default_rng(5)

    def block(depth):
        tag = rng.choice(["div", "section", "p", "p"]) if depth < 3 else "p"
        if tag == "p":
            shared = rng.random() < 0.3
            return f"<p>{'shared ' + str(rng.integers(6)) if shared else 'own ' + str(rng.integers(10**12))}</p>"
        name = rng.choice(["", ' class="x"', ' class="y"'])
        return f"<{tag}{name}>{''.join(block(depth + 1) for _ in range(rng.integers(1, 4)))}</{tag}>"

    pages = []
    for i in range(120):
        slot = f"<section><p>w{rng.integers(10**6)}</p></section>"
        pages.append((f"h{i % 5}.org", f"<body>{slot}{''.join(block(0) for _ in range(rng.integers(2, 7)))}</body>"))
    pages += pages[:7]
    rows = [(i, f"http://{host}/{i}", source, "", "") for i, (host, source) in enumerate(pages)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    expected, templates = _plain_extract(pages)
    assert len(templates) == 5 and sum(k.startswith("/section") for keys in templates.values() for k in keys) >= 1
    assert [got[i] for i in range(len(pages))] == expected


def test_slots_with_other_words_go(spark):
    rows = []
    for i in range(10):
        own = "".join(f"<p>Paragraph {j} of page {i} with words of its own.</p>" for j in range(3 + i % 3))
        rows.append((i, f"http://n.org/{i}", f"<body><div class=top{i}>Tip {i * 7919}</div><div class=text>{own}</div><div class=foot>Seen {i * 31} times</div></body>", "", ""))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == "\n".join(f"Paragraph {j} of page {i} with words of its own." for j in range(3 + i % 3)) for i in range(10))


def test_articles_stay_whatever_their_class():
    assert page_text('<article class="post category-privacy tag-ads"><p>one</p></article>') == "one"
    assert page_text('<div id="content" class="no-sidebar has-comments"><p>one</p></div>') == "one"
    assert page_text('<article><p class="search">a</p><section class="related"><p>b</p></section><p>c <math>d</math></p></article>') == "a\nb\nc d"
    assert page_text('<article><p>a long enough text</p><section class="related"><a href="/">b</a></section></article>') == "a long enough text"
    assert page_text("<article><p>short</p><div class=comments><p>many words of the readers of this</p></div></article>") == "short"


def test_pages_broken_markup_and_time():
    import time

    assert page_text("<p title=it's>one</p><p>mid</p><p title=he's>two</p>") == "one\nmid\ntwo"
    assert page_text("<p>a < b</p><p>1 <2</p>") == "a < b\n1 <2" and page_text("x <!-- y") == "x" and page_text("a <b") == "a <b"
    assert page_text("<p data-a='>' data-b=\">\">one<!-->two<br/>three") == "onetwo three"
    n = 1 << 15
    for source in ("<a " * 8 * n, "<b>" * n + "</i>" * n, "<b>" * n + "<hr>" * n, "<li><ul>" + "<div>" * n + "<li></li>" * n, '<a x="' * n, "<!--" * n, "<a b=" * n + ">", "<article>" * n):
        start = time.process_time()
        page_text(source)
        assert time.process_time() - start < 15
