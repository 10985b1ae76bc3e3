"""Registered queries of the operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bvengine.llm import (
    bpe, embedding_join, exact_dedup, hard_negatives, order_minhash, packing, pii, sharding, substring_dedup, token_alignment, toxicity,
    url_filter, warc,
)
from bvengine.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.link(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_filter.judge(table(spark, sf_dir, "pages"), marks)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.report(table(spark, sf_dir, "documents"), a, b)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_embedding_join, op3_bpe, op4_exact_dedup, op5_url_filter, op6_toxicity, op7_packing, op8_order_minhash,
        op9_sharding, op10_warc, op11_substring_dedup, op12_token_alignment, op13_hard_negatives, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op2_embedding_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.98::DOUBLE ELSE false END
        ),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS least FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.least, e.vec_id)) AS component_id,
               e.vec_id <= coalesce(c.least, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
    """,
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS x FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(x) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY x)
    """,
    "op5_url_filter": """
        WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS x FROM pages),
        p AS (
            SELECT page_id, coalesce(regexp_extract(x, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   coalesce(translate(regexp_extract(x, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host
            FROM u
        ),
        g(name, prefix, said) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ),
        m AS (
            SELECT p.page_id, arg_max(g.name || g.prefix, length(g.name || g.prefix)) AS rule, arg_max(g.said, length(g.name || g.prefix)) AS said
            FROM p JOIN g ON (p.host = g.name OR ends_with(p.host, '.' || g.name)) AND starts_with(p.path, g.prefix) GROUP BY p.page_id
        ),
        h AS (
            SELECT p.host, count(l.quality)::DOUBLE AS n, coalesce(sum(l.quality), 0)::DOUBLE AS k, string_split(p.host, '.') AS parts
            FROM p LEFT JOIN labels l ON l.doc_id = p.page_id AND l.quality IN (0, 1) GROUP BY p.host
        ),
        s AS (
            SELECT *, array_to_string(parts[greatest(1, len(parts) - 1):], '.') IN (
                       'co.uk', 'ac.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'co.nz', 'com.br', 'co.in', 'co.za', 'com.cn', 'com.mx'
                   ) AS two FROM h
        ),
        d AS (
            SELECT host, n, k, array_to_string(parts[greatest(1, len(parts) - two::INT):], '.') AS suffix,
                   array_to_string(parts[greatest(1, len(parts) - 1 - two::INT):], '.') AS dom FROM s
        ),
        w AS (SELECT *, (sum(k) OVER () + 1::DOUBLE) / (sum(n) OVER () + 2::DOUBLE) AS base FROM d),
        x AS (SELECT *, (sum(k) OVER of_s + 20::DOUBLE * base) / (sum(n) OVER of_s + 20::DOUBLE) AS s_mean FROM w WINDOW of_s AS (PARTITION BY suffix)),
        y AS (SELECT *, (sum(k) OVER of_d + 20::DOUBLE * s_mean) / (sum(n) OVER of_d + 20::DOUBLE) AS d_mean FROM x WINDOW of_d AS (PARTITION BY suffix, dom)),
        z AS (SELECT host, base, n + 20::DOUBLE AS t, (k + 20::DOUBLE * d_mean) / (n + 20::DOUBLE) AS mean FROM y),
        o AS (SELECT host, mean, mean + 1.645::DOUBLE * sqrt(mean * (1 - mean) / (t + 1)) < 0.9::DOUBLE * base AS bad FROM z)
        SELECT p.page_id, p.host, p.path, m.rule, CASE WHEN m.rule IS NOT NULL THEN m.said WHEN o.bad THEN 'block' ELSE 'allow' END AS verdict,
               CASE WHEN m.rule IS NULL THEN o.mean END AS host_mean
        FROM p JOIN o ON o.host = p.host LEFT JOIN m ON m.page_id = p.page_id
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        q AS (SELECT page_id, h, n, max(page_id) OVER (PARTITION BY h) AS m FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
        FROM q
    """,
    "op11_substring_dedup": """
        WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        s AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM t WHERE len(w) >= 13),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM s),
        d AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first FROM g) WHERE first < doc_id),
        r AS (SELECT DISTINCT doc_id, i + j AS k FROM d, generate_series(0, 12) AS o(j)),
        p AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS k FROM t WHERE len(w) > 0),
        k AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.k) AS kept FROM p ANTI JOIN r ON p.doc_id = r.doc_id AND p.k = r.k GROUP BY p.doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id)
        SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM t LEFT JOIN n ON t.doc_id = n.doc_id LEFT JOIN k ON t.doc_id = k.doc_id
    """,
    "op13_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ),
        p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
        SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS rank,
               s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
}
