"""The registered queries of the corpus operators, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroid_clusters, exact_dedup, fingerprints, hard_negatives, html_extract, ngram_join, packing, pii, quality, super_minhash, token_counts, warc
from .common import scratch_path, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    out = warc.resolve(warc.read(spark, path))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed="2", dims=64)


def op12_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_minhash.near_duplicates(table(spark, sf_dir, "documents"), n=2, num=80, den=100)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_html_extract": op2_html_extract,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_bpe": op5_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_fingerprints": op7_fingerprints,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_super_minhash": op12_super_minhash,
    "op13_hard_negatives": op13_hard_negatives,
}


def _rounds_sql(k: int, rounds: int, seed: str, dims: int) -> str:
    """DuckDB SQL of ``centroid_clusters``: one pair of tables a round."""
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND list_count(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS INTEGER) AS c, x FROM v
  ORDER BY c LIMIT {k}),"""
    for i in range(rounds + 1):
        sql += f"""
far{i} AS (SELECT r, c, list_sum(list_transform(list_zip(v.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i}),
a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, CAST(min(d) AS BIGINT) AS d FROM far{i} GROUP BY r),"""
        if i < rounds:
            sql += f"""
m{i} AS (SELECT c, dim, CAST(floor(sum(y) / count(*)) AS BIGINT) AS y
         FROM (SELECT a{i}.c, unnest(v.x) AS y, generate_subscripts(v.x, 1) AS dim FROM a{i} JOIN v USING (r)) GROUP BY c, dim),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.x, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT c, list(y ORDER BY dim) AS x FROM m{i} GROUP BY c) n USING (c)),"""
    return sql + f"""
s AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY c)
SELECT v.vec_id, a.c AS cluster, a.d AS distance, s.cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia,
       sha256(array_to_string(z.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN s USING (c) JOIN c{rounds} z USING (c)
"""



ORACLE: dict[str, str] = {
    "op1_ngram_join": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM split),
one AS (SELECT doc_id, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
         WHERE 100 * c >= 90 * (len(p.s) + len(q.s) - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(reach.b) AS component_id, coalesce(any_value(degree.n), 0) AS n_links
FROM sets JOIN reach ON reach.a = doc_id LEFT JOIN degree ON degree.a = doc_id GROUP BY doc_id, len(s)
""",
    "op3_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(body) AS payload_bytes,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest
  FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM m
""",
    "op8_exact_dedup": r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER grp AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER grp = 1 AS kept,
       sha256(body) AS text_sha256
FROM norm
WINDOW grp AS (PARTITION BY body ORDER BY points DESC, doc_id)
""",
    "op11_centroid_clusters": _rounds_sql(40, 5, "2", 64),
    "op12_super_minhash": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM split),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM one a
        JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
         WHERE 100 * c >= 80 * (len(p.s) + len(q.s) - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(reach.b) AS component_id, doc_id = min(reach.b) AS kept
FROM sets JOIN reach ON reach.a = doc_id GROUP BY doc_id, len(s)
""",
    "op13_hard_negatives": r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
             other_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
      WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3
""",
}
