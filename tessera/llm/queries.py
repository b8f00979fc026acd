"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe_codec, exact, extraction, fingerprints, importance, licenses, packing, quality, repeats, simhash, token_counts, trie, warc
from tessera.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048, 1)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), 100)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"), 400)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups_within_two(table(spark, sf_dir, "documents"), 3)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_nodes(table(spark, sf_dir, "conversations"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_warc": op3_warc,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_fingerprints": op5_fingerprints,
    "op6_licenses": op6_licenses,
    "op7_simhash": op7_simhash,
    "op8_extraction": op8_extraction,
    "op9_token_counts": op9_token_counts,
    "op10_repeats": op10_repeats,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_importance": op12_importance,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality": quality.oracle(),
    "op3_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f""",
    "op6_licenses": licenses.oracle(),
    "op13_exact_dedup": exact.oracle(),
}
