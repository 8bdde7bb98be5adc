"""The registered queries of the training-data operators, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ravelin.llm import band_join, conversation_trie, decontamination, language_id, license_scan, license_sql, near_dedup, packing, shop_sql, suffix_dedup, token_counts, token_files, top_k, toxicity, url_filter
from ravelin.llm.common import materialize, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Settings(shingle=3, similar=(85, 100), bands=36, rows=7))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_token_counts(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_token_files(table(spark, sf_dir, "documents")).read()


#: The rules of op10, as (verdict, host/path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_join.band_join(table(spark, sf_dir, "sale_lines"), table(spark, sf_dir, "items"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.digested(table(spark, sf_dir, "conversations"))
    ordered = materialize(conversation_trie.in_order(turns).select("conv_id", "at", "digest", "n_bytes"), "conversations-in-order")
    return conversation_trie.prefix_trie(conversation_trie.rebuilt(ordered), ordered.select("conv_id"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_toxicity, op3_exact_top_k, op4_decontamination, op5_minhash_near_dedup, op6_language_id, op7_token_counts, op8_license_scan, op9_token_files, op10_url_filter, op11_band_join, op12_conversation_trie, op13_suffix_dedup)}

ORACLES: dict[str, str] = {}

ORACLES["op11_band_join"] = shop_sql.OP11

ORACLES["op12_conversation_trie"] = shop_sql.OP12

ORACLES["op13_suffix_dedup"] = shop_sql.OP13

ORACLES["op8_license_scan"] = license_sql.oracle()

ORACLES["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
n AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
sym AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT s.v, r.seen FROM reach r JOIN sym s ON s.u = r.node)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept
FROM n JOIN reach r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""

ORACLES["op3_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
