"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    best_fit,
    embedding_dedup,
    exact_topk,
    html_text,
    jaccard_join,
    language_id,
    mixing,
    packing,
    substring_dedup,
    token_alignment,
    token_counts,
    toxicity,
    whitening,
)
from llm.tables import read
from swellmark.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package wherever the driver was started; a cluster has it at the same path or installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *(p for p in paths if p)])
    return spark


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(importable(spark), sf_dir, "embeddings"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(importable(spark), sf_dir, "pages"))


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(importable(spark), sf_dir, "documents"))


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(importable(spark), sf_dir, "embeddings")
    return exact_topk.exact_topk(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(importable(spark), sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(importable(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(importable(spark), sf_dir, "documents")).drop("ids")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_passages(read(importable(spark), sf_dir, "documents"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = scratch_path(importable(spark), "token-cache")
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), cache)


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken")


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(read(importable(spark), sf_dir, "documents"), outputs=("groups_sha256",))


def best_fit_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_best_fit(read(importable(spark), sf_dir, "documents"), keep_ids=False)


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that no long holds (from some millions of vectors on) is null here; the operator's decimal has it."""
    rows = whitening.whiten(read(importable(spark), sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": near_vectors,
    "op2_html_extraction": page_texts,
    "op3_ngram_jaccard_join": jaccard,
    "op4_exact_topk": topk,
    "op5_language_id": languages,
    "op6_toxicity": toxic,
    "op7_packing": packed,
    "op8_substring_dedup": passages,
    "op9_token_counts": tokens,
    "op10_mixing": mixed,
    "op11_tokenizer_alignment": alignment,
    "op12_best_fit_packing": best_fit_packed,
    "op13_embedding_whitening": whitened,
}

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": f"""
        with recursive v as materialized (
            select vec_id, embedding::double[] as e from embeddings
            where {_FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links as materialized (
            select a.vec_id as a, b.vec_id as b from v a join v b
            on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9
        ),
        reach as (
            select vec_id as a, vec_id as b from embeddings
            union select r.a, l.b from reach r join links l on l.a = r.b
        ),
        low as (select a, min(b) as component_id from reach group by a),
        degree as (select a, count(*) as n from links group by a)
        select e.vec_id, coalesce(n, 0) as n_links, component_id, e.vec_id = component_id as kept
        from embeddings e join low on low.a = e.vec_id left join degree d on d.a = e.vec_id""",
    "op3_ngram_jaccard_join": r"""
        with recursive w as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as ws from documents
        ),
        sets as materialized (
            select doc_id, list_distinct(case
                when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from w
        ),
        shingles as materialized (select doc_id, len(s) as n, unnest(s) as g from sets),
        common as (
            select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c
            from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id group by all
        ),
        links as materialized (select a, b from common where 100 * c >= 80 * (na + nb - c)),
        reach as (
            select doc_id as a, doc_id as b from documents
            union select r.a, l.b from reach r join links l on l.a = r.b
        )
        select doc_id, len(s) as n_shingles, component_id
        from sets join (select a, min(b) as component_id from reach group by a) low on low.a = doc_id""",
    "op4_exact_topk": f"""
        with v as materialized (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e
            from embeddings where {_FINITE}
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id as vec_id,
                list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
            from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
        ),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 10""",
}
