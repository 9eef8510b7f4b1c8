"""Queries of the operators of this package, with production parameters."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import table
from .alignment import align_corpus
from .common import shared_path
from .e8 import lattice_components
from .langid import is_held_out, predict, train
from .mixing import mix_sources
from .packing import pack_documents
from .permutation import permutation_search
from .pii import KINDS as PII_KINDS, all_spans, count_rank, find_pii
from .rarity import compare_neighbours
from .secrets import KINDS, count_kind, secret_spans, span_digest, span_text
from .simhash import simhash_components
from .tokencount import count_tokens
from .warc import read_records, write_bundles
from .whitening import whiten

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash_components(spark, sf_dir):
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op5_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_lattice_components(spark, sf_dir):
    return lattice_components(table(spark, sf_dir, "embeddings"), least=0.9)


@query
def op1_permutation_index(spark, sf_dir):
    return permutation_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op4_secret_links(spark, sf_dir):
    out = secret_spans(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin([k.name for k in KINDS if k.strong]))
    return out.select("doc_id", *[count_kind(spans, k.name).alias(f"n_{k.name}") for k in KINDS],
                      span_digest(base).alias("base_sha256"), span_text(spans).alias("spans"))


@query
def op8_poisson_mixture(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE["op8_poisson_mixture"] = """
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS chars FROM documents GROUP BY source),
whole AS (SELECT sum(chars)::DOUBLE AS total, count(*) FILTER (chars > 0)::DOUBLE AS weight FROM sizes),
rates AS (SELECT source, CASE WHEN chars > 0 THEN total * (1.0::DOUBLE / weight) / chars ELSE 1.0 END::DOUBLE AS rate
          FROM sizes, whole),
steps AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates),
logs AS (SELECT source, rate, k, sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k) AS lf FROM steps),
cdfs AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lf)) OVER (PARTITION BY source ORDER BY k) AS cdf FROM logs),
tables AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM cdfs GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(cdf, lambda p: p < (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
                                            ::DOUBLE + 1) / 4503599627370496.0)) AS times
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT * EXCLUDE (times), unnest(range(0, times))::INT AS copy FROM drawn)
SELECT *, (('0x' || substr(md5('mix/place:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 13))::BIGINT
           ::DOUBLE + 1) / 4503599627370496.0 AS place FROM copies
"""


@query
def op6_warc_bundles(spark, sf_dir):
    folder = shared_path(spark, "warc")
    index = write_bundles(table(spark, sf_dir, "pages"), folder)
    out = read_records(index, folder, payload=False)
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_pii_spans(spark, sf_dir):
    out = find_pii(table(spark, sf_dir, "documents"))
    none = F.array().cast("array<struct<start:int,end:int,part:double>>")
    return out.select(
        "doc_id", *[count_rank(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(PII_KINDS)],
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(all_spans(F.col("base"), none), 256).alias("base_sha256"),
        all_spans(F.col("base"), F.col("terms")).alias("spans"))


@query
def op11_feast_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), k=16)


@query
def op12_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = align_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_rarity_digest(spark, sf_dir):
    return compare_neighbours(table(spark, sf_dir, "documents"))


ORACLE["op6_warc_bundles"] = """
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
                       min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41),
           lambda i: lpad(bin(('0x' || substr(hex, i, 1))::INT), 4, '0')), '') AS b FROM pages_)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT + 4 * substr(b, 5 * i + 3, 1)::INT
           + 2 * substr(b, 5 * i + 4, 1)::INT + substr(b, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM bits
"""

# all pairs and all paths: for small tables only
ORACLE["op10_lattice_components"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
          ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON a = vec_id
"""
