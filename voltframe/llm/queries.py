"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import (bpe, fingerprints, jaccard_join, language_id, mixing, pii, quality_rules,
                           rule_ensemble, suffix_dedup, toxicity, va_clusters, vector_codes, warc)
from voltframe.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document, learned from the labels that are not held out."""
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to seekable WARC bundles and read back."""
    rows = warc.archive_and_read(read_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document: base spans and those that the labelers' model adds."""
    return pii.find(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix to target weights takes of each document."""
    rows = mixing.mixture(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, learned from the labels that are not held out."""
    return rule_ensemble.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without the 50-byte strings that earlier ones have."""
    return suffix_dedup.digests(read_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are at least 90 % alike."""
    return jaccard_join.join(read_table(spark, sf_dir, "documents"), 3, jaccard_join.Threshold(9, 10))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol and repetition counts of each document and the rules' joint verdict."""
    rows = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "good_probability")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how like they are."""
    return fingerprints.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of each embedding: its parts' nearest entries in four learned codebooks."""
    return vector_codes.encode(read_table(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from the documents that are not held out."""
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op13_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of 16 learned centroids of each embedding."""
    return va_clusters.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_fingerprints": op10_fingerprints,
    "op11_vector_codes": op11_vector_codes,
    "op12_language_id": op12_language_id,
    "op13_va_clusters": op13_va_clusters,
}

_FINITE = """embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _nearest_rounds(rounds: int) -> str:
    """CTEs c1 .. c<rounds> (entries) and a0 .. a<rounds> (nearest entry and distance) from x(r, part, i, x) and c0(part, entry, i, x)."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT r, part, min({{'d': d, 'e': entry}}) AS best
  FROM (SELECT x.r, x.part, c.entry, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d
        FROM x JOIN c{k} c ON c.part = x.part AND c.i = x.i GROUP BY x.r, x.part, c.entry)
  GROUP BY r, part)""")
        if k < rounds:
            out.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.i, coalesce(m.x, c.x) AS x
  FROM c{k} c LEFT JOIN (
    SELECT x.part, a.best.e AS entry, x.i, CAST(floor(CAST(sum(x.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM x JOIN a{k} a ON a.r = x.r AND a.part = x.part GROUP BY x.part, a.best.e, x.i) m
  ON m.part = c.part AND m.entry = c.entry AND m.i = c.i)""")
    return ",\n".join(out)

ORACLE_SQL: dict[str, str] = {
    "op2_warc": r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(digest, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS BIGINT) + 1,
         1)), '') AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
""",
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3 AS cap, place, (place - 1) % 3 + 1 AS weight,
         CAST(source_size * 3 AS DOUBLE) / ((place - 1) % 3 + 1) AS full_at
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM totals)),
levels AS (
  SELECT *, row_number() OVER w AS rnk,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
           / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed WINDOW w AS (ORDER BY full_at, place)),
water AS (SELECT min_by(level, rnk) FILTER (WHERE level <= full_at) AS water FROM levels),
targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), coalesce(water * weight, CAST(cap AS DOUBLE))) AS target
  FROM levels, water),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
           / CAST(4503599627370496 AS DOUBLE) AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * copies AS BIGINT) AS taken, copies
FROM (SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies FROM rated)
""",
    "op11_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE}),
x AS MATERIALIZED (
  SELECT r, CAST(d // 16 AS INT) AS part, CAST(d % 16 AS INT) AS i, v[d + 1] AS x FROM kept, range(64) t(d)),
c0 AS MATERIALIZED (SELECT part, CAST(r - 1 AS INT) AS entry, i, x FROM x WHERE r <= 256),
{_nearest_rounds(4)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a4 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) FROM c4) AS codebooks_sha256
FROM kept JOIN coded USING (r)
""",
    "op13_va_clusters": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE}),
x AS MATERIALIZED (SELECT r, 0 AS part, CAST(d AS INT) AS i, v[d + 1] AS x FROM kept, range(64) t(d)),
c0 AS MATERIALIZED (SELECT part, CAST(r - 1 AS INT) AS entry, i, x FROM x WHERE r <= 16),
{_nearest_rounds(3)},
hashes AS (SELECT entry, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY entry)
SELECT vec_id, a3.best.e AS cluster, a3.best.d AS distance,
       CAST(sum(a3.best.d) OVER (PARTITION BY a3.best.e) AS BIGINT) AS cluster_inertia,
       CAST(sum(a3.best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a3 USING (r) JOIN hashes ON hashes.entry = a3.best.e
""",
}
