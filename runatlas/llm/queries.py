"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.llm import (
    chat_format,
    decontaminate,
    jaccard_join,
    language_mix,
    license_scan,
    merkle_manifest,
    prefix_trie,
    secret_scan,
    simhash_pivots,
    spot_signatures,
    token_counts,
    warc,
    word_bpe,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.predict_languages(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return word_bpe.encode_documents(_table(spark, sf_dir, "documents"), path, keep=())


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprints(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_conversations(_table(spark, sf_dir, "conversations"))


def op7_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder for each source, language and range of ids."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    folder = F.floor(F.col("doc_id") / 400).cast("string")
    path = F.concat_ws("/", "source", "lang", folder, name)
    files = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return license_scan.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op11_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document or so, by the checksum of its id, claims a text with A-Z in lower case."""
    docs = _table(spark, sf_dir, "documents")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = F.when(tampered, F.translate("text", letters, letters.lower())).otherwise(F.col("text"))
    return merkle_manifest.verify(docs, {"text": claimed})


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.grafted_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_language_mix": op1_language_mix,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_spot_signatures": op4_spot_signatures,
    "op5_token_counts": op5_token_counts,
    "op6_chat_format": op6_chat_format,
    "op7_bm25_decontamination": op7_bm25_decontamination,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc_zstd": op9_warc_zstd,
    "op10_license_scan": op10_license_scan,
    "op11_simhash_pivots": op11_simhash_pivots,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op2_ngram_jaccard_join": """WITH RECURSIVE
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, list_aggregate(list_slice(words, i, i + 4), 'string_agg', ' ') AS s
  FROM split, LATERAL (SELECT unnest(range(1, greatest(len(words) - 3, 2))) AS i) WHERE len(words) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY ALL),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id""",
    "op9_warc_zstd": """WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload,
    CASE WHEN strlen(coalesce(html, '')) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS head
  FROM pages)
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM page""",
    "op12_merkle_manifest": """WITH RECURSIVE
byte AS (SELECT list(c ORDER BY n) AS crc FROM (
  SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) AS c
  FROM range(256) AS t(n))),
doc AS (
  SELECT doc_id, lang, row_number() OVER () AS place, CASE WHEN xor(4294967295, list_reduce(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT),
      lambda c, d: xor(crc[(xor(c, d) & 255) + 1], c >> 8), 4294967295)) % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents, byte),
leaf AS (
  SELECT doc_id, lang, sha256(head || body) AS leaf, sha256(head || coalesce(strlen(claimed) || ':' || claimed, '-')) AS claim,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS size
  FROM doc),
node AS (
  SELECT lang, size, 0 AS level, pos, leaf AS h FROM leaf
  UNION ALL
  SELECT lang, any_value(size), level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM node
  WHERE ceil(size / 8.0 ** level) > 1 GROUP BY lang, level, pos // 8),
head AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM node WHERE ceil(size / 8.0 ** level) <= 1),
top AS (
  SELECT size, 0 AS level, pos, subroot AS h FROM head
  UNION ALL
  SELECT any_value(size), level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top
  WHERE ceil(size / 8.0 ** level) > 1 GROUP BY level, pos // 8),
hop AS (
  SELECT lang, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM node WHERE ceil(size / 8.0 ** level) > 1 GROUP BY ALL),
top_hop AS (SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM top WHERE ceil(size / 8.0 ** level) > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, lang, leaf, 0 AS level, pos, claim AS h, '' AS seen FROM leaf
  UNION ALL
  SELECT c.doc_id, c.lang, leaf, c.level + 1, pos // 8,
    sha256(array_to_string(hs[:pos % 8], '') || c.h || array_to_string(hs[pos % 8 + 2:], '')),
    seen || array_to_string(hs[:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM climb c JOIN hop ON c.lang IS NOT DISTINCT FROM hop.lang AND c.level = hop.level AND c.pos // 8 = hop.run),
climbed AS (
  SELECT doc_id, leaf, head.subroot, 0 AS level, head.pos, h, seen FROM head JOIN (
    SELECT *, max(level) OVER (PARTITION BY lang) AS last FROM climb) c ON c.lang IS NOT DISTINCT FROM head.lang AND c.level = c.last
  UNION ALL
  SELECT doc_id, leaf, subroot, c.level + 1, pos // 8,
    sha256(array_to_string(hs[:pos % 8], '') || c.h || array_to_string(hs[pos % 8 + 2:], '')),
    seen || array_to_string(hs[:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM climbed c JOIN top_hop ON c.level = top_hop.level AND c.pos // 8 = top_hop.run),
root AS (SELECT h AS root FROM top WHERE ceil(size / 8.0 ** level) <= 1)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, h AS folded_root, h = root AS verified
FROM climbed, root WHERE level = (SELECT max(level) FROM climbed)""",
    "op13_prefix_trie": """WITH
byte AS (SELECT list(c ORDER BY n) AS crc FROM (
  SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) AS c
  FROM range(256) AS t(n))),
conv AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
graft AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ord(d)::BIGINT),
    lambda c, d: xor(crc[(xor(c, d) & 255) + 1], c >> 8), 4294967295)) % 4 AS h
  FROM conv, byte),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM graft c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefix AS (SELECT conv_id, d AS depth, turns[:d] AS path, len(turns) AS n FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth > 0 THEN len(list_filter(regexp_split_to_array(path[depth].text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) ELSE 0 END AS saved
  FROM prefix GROUP BY path, depth),
child AS (SELECT path[:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
known AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (path)),
below AS (
  SELECT path[:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM known, LATERAL (SELECT unnest(range(depth + 1)) AS d) GROUP BY ALL)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (path) LEFT JOIN node p ON k.depth > 0 AND p.path = k.path[:k.depth - 1] AND p.depth = k.depth - 1""",
}
