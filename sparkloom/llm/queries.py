"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import counts, jaccard, neighbours, packing, pieces, pii, sharding, top_k, toxicity, warc
from .common import table


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; every executor has the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_inner_products(table(spark, sf_dir, "embeddings"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_spans(table(spark, sf_dir, "documents")).drop("all_spans")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(table(spark, sf_dir, "documents"), 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_top_k": op2_top_k,
    "op3_pieces": op3_pieces,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op8_token_counts": op8_token_counts,
    "op10_packing": op10_packing,
    "op6_neighbours": op6_neighbours,
    "op7_warc": op7_warc,
    "op9_sharding": op9_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op1_jaccard": """
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
            from documents
        ),
        s as (
            select doc_id, list_distinct(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
                                              when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh
            from w
        ),
        u as (select doc_id, len(sh) as n, unnest(sh) as t from s),
        l as (
            select a.doc_id as a, b.doc_id as b from u a join u b on a.t = b.t and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ),
        reach(node, other) as (
            select doc_id, doc_id from documents
            union
            select reach.node, l.b from reach join l on reach.other = l.a
        ),
        c as (select node, min(other) as component_id from reach group by 1)
        select doc_id, cast(len(sh) as bigint) as n_shingles, component_id from s join c on doc_id = node
    """,
    "op2_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
            from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ),
        s as (
            select a.vec_id as query_id, b.vec_id as vec_id,
                   cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
            from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
            where a.vec_id % 50 = 0
        ),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
    """,
    "op6_neighbours": """
        with recursive v as (
            select vec_id, embedding::double[] as e, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as n
            from embeddings
            where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ),
        l as (
            select a.vec_id as a, b.vec_id as b
            from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and a.n > 0 and b.n > 0
            where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95
        ),
        reach(node, other) as (
            select vec_id, vec_id from embeddings
            union
            select reach.node, l.b from reach join l on reach.other = l.a
        ),
        c as (select node, min(other) as component_id from reach group by 1),
        k as (select a, count(*) as n_links from l group by 1)
        select vec_id, cast(coalesce(n_links, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
        from embeddings join c on vec_id = node left join k on vec_id = a
    """,
    "op7_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
        d as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest from p),
        g as (select payload_digest as g_digest, max(page_id) as head from d where payload_bytes >= 1000 group by 1)
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
               case when head is null or head = page_id then 'response' else 'revisit' end as record_type,
               case when head <> page_id then head end as refers_to
        from d left join g on payload_digest = g_digest
    """,
}
