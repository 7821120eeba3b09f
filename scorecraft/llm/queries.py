"""Registered queries of the operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_decode
from .centroids import cluster_vectors, digest
from .common import table
from .decontaminate import find_contamination
from .divergence import source_divergence
from .line_dedup import PASSAGE, dedup_lines
from .packing import pack
from .phrases import edited_likeness
from .pii import BASE_KINDS, find_pii, span_list
from .quality import judged
from .sharding import byte_shards
from .simhash import simhash_groups
from .sql import CENTROIDS_SQL, CONTAMINATION_SQL, DIVERGENCE_SQL
from .token_store import read_tokens, write_tokens
from .url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


# ------------------------------------------------------------------ op1: URLs
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/")]

#: The listed addresses are those of the pages whose id is divisible by 20.
_URL_SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(u, '^.*?://[^?#]*\?([^#]*)', 1, 's') AS query
  FROM parts
), canon AS (
  SELECT page_id, host, path,
    regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '/+$', '') AS base,
    list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT
      regexp_matches(p, '^(utm_[^=&]*|ref|gclid|fbclid)(=|$)'))) AS kept
  FROM split
), done AS (
  SELECT page_id, host, path, base || CASE WHEN len(kept) > 0
    THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM canon
), hits AS (
  SELECT DISTINCT canonical FROM done WHERE page_id % 20 = 0 AND canonical <> ''
), judged AS (
  SELECT d.*, h.canonical IS NOT NULL AS listed,
    CASE WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/en/1')
           THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/es/')
           THEN 'example.org/es/'
         WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/') THEN 'org/'
    END AS rule
  FROM done d LEFT JOIN hits h ON d.canonical = h.canonical
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical, listed
FROM judged
"""


@register("op1_url_filter", _URL_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, pages.filter("page_id % 20 = 0"), URL_RULES)


# ------------------------------------------------------------------- op2: PII
@register("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"], beyond=True)
    found = found.select("doc.doc_id", "base", "added")

    def n_of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[n_of(k.name) for k in BASE_KINDS],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"))


# -------------------------------------------------------------- op3: byte BPE
@register("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = encode_decode(table(spark, sf_dir, "documents"),
                          tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


# --------------------------------------------------------------- op4: packing
@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


# ------------------------------------------------------------ op5: quality rules
@register("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judged(docs, keep=["doc_id"]).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "log_perplexity", "low", "high")


# ------------------------------------------------------- op6: SimHash near-dedup
@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=3)


# -------------------------------------------------------------- op7: sharding
@register("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "start_byte")


# ----------------------------------------------------------- op8: token files
@register("op8_token_store")
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = write_tokens(table(spark, sf_dir, "documents"),
                                 tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return read_tokens(files, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# ------------------------------------------------------------ op9: line dedup
@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return dedup_lines(docs, min_words=PASSAGE).select(
        "doc.doc_id", "doc.text", "doc.n_chars", "n_removed")


# -------------------------------------------------- op10: document fingerprints
@register("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_likeness(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


# ------------------------------------------------ op11: benchmark decontamination
@register("op11_decontaminate", CONTAMINATION_SQL)
def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("exact").cast("long").alias("n_items"),
        F.sha2(F.array_join("exact", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"))


# ------------------------------------------------ op12: source divergence audit
@register("op12_divergence", DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


# ------------------------------------------------------- op13: centroid clustering
@register("op13_centroids", CENTROIDS_SQL)
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest("centroid").alias("centroid_sha256"))
