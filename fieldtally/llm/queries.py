"""The queries ``opN_<name>``: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, dac, embeddings, fingerprints, media, minhash, packing, quality, token_counts, toxicity, url_filter, whitening

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), BYTE_BPE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), WORD_BPE, end_id=1)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return toxicity.toxicity_scores(docs, _labels(spark, sf_dir)).select("row.doc_id", "toxicity.*")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_documents(spark, sf_dir), WORD_BPE)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return quality.quality_scores(docs, _labels(spark, sf_dir)).select("row.doc_id", "quality.*")


#: The rules that the query's contract fixes.
RULES = [
    url_filter.Rule("com", "/en/", "block"),
    url_filter.Rule("example.com", "/en/7", "allow"),
    url_filter.Rule("net", "/de/", "allow"),
    url_filter.Rule("example.net", "/de/8", "block"),
    url_filter.Rule("org", "/es/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = dac.write_token_files(_documents(spark, sf_dir), WORD_BPE, end_id=2)
    return dac.read_token_files(files.read())


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(_documents(spark, sf_dir))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near``: how many other values among all fingerprints are within 3 bits."""
    compared = fingerprints.compare_with_next(_documents(spark, sf_dir))
    near = fingerprints.near_counts(compared.select("fingerprint"))
    return compared.join(near, "fingerprint", "left").fillna(0, ["n_near"])


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_packing": op2_packing,
        "op3_toxicity": op3_toxicity,
        "op4_bpe": op4_bpe,
        "op5_quality": op5_quality,
        "op6_url_filter": op6_url_filter,
        "op7_token_files": op7_token_files,
        "op8_media": op8_media,
        "op9_embedding_near_dedup": op9_embedding_near_dedup,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_alignment": op11_alignment,
        "op12_fingerprints": op12_fingerprints,
        "op13_whitening": op13_whitening,
    }


_OP6_SQL = r"""
WITH split AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
best AS (
  SELECT s.*, (SELECT max_by(struct_pack(name := rule_host || rule_path, verdict := rule_verdict), length(rule_host || rule_path))
    FROM rules WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS b
  FROM split s)
SELECT page_id, host, path, b.name AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best
"""


_OP9_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.node WHERE reach.root < link.b),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN degree ON a = vec_id
"""

_OP10_SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) END AS s FROM word),
shingle AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM sets),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.node WHERE reach.root < link.b),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON node = doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": _OP6_SQL, "op9_embedding_near_dedup": _OP9_SQL, "op10_minhash_near_dedup": _OP10_SQL}
