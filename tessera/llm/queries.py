"""The registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, four_russians, idfiles, langid, merkle, packing, pivot_search, quality_gam, robust, simhash, substrings,
                         toxicity, warc)
from tessera.llm.common import documents
from tessera.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokeniser file lies (never copied into this repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@_query("op1_bpe_tree_concat")
def op1(spark, sf_dir):
    return bpe.encode_digests(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())


@_query("op2_language_id")
def op2(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


@_query("op3_length_buckets")
def op3(spark, sf_dir):
    return packing.length_buckets(packing.token_counts(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path()))


OP4_SQL = """
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@_query("op4_pivot_search", OP4_SQL)
def op4(spark, sf_dir):
    return pivot_search.top_k(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity.classify(documents(spark, sf_dir, "doc_id", "text"), load(spark, sf_dir, "labels"))


@_query("op6_id_files")
def op6(spark, sf_dir):
    return idfiles.round_trip(spark, documents(spark, sf_dir, "doc_id", "text"), tokenizer_path(), end_id=2)


@_query("op7_robust_rules", robust.oracle_sql())
def op7(spark, sf_dir):
    return robust.verdicts(documents(spark, sf_dir, "doc_id", "text", "lang", "source")).drop("distance2")


@_query("op8_sentence_spans")
def op8(spark, sf_dir):
    return substrings.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))


@_query("op9_simhash_pivots")
def op9(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@_query("op10_quality_gam")
def op10(spark, sf_dir):
    return quality_gam.classify(documents(spark, sf_dir, "doc_id", "text"), load(spark, sf_dir, "labels"))


OP11_SQL = """
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(x.v)) + 1), lambda i: a.v[i] * x.v[i])), 0) AS BIGINT) AS score
  FROM usable a JOIN usable x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


@_query("op11_four_russians", OP11_SQL)
def op11(spark, sf_dir):
    rows = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@_query("op12_warc_chunks", OP12_SQL)
def op12(spark, sf_dir):
    return warc.round_trip(load(spark, sf_dir, "pages").select("page_id", "url", "html"))


@_query("op13_merkle_checkpoints", merkle.oracle_sql())
def op13(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    return merkle.manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
