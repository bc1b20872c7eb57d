"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import warnings

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, conversation_trie, decontaminate, html_text, language, pii, quality, secrets, simhash, topk, urls, vector_codes
from .common import table

#: The vocabulary file of the tokenizer, and its pattern.
RANKS = "byte_bpe_50k.tiktoken"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(pii.KEY_SETTING, None)
    if not key:
        warnings.warn(f"{pii.KEY_SETTING} is not set: pseudonyms are made with a public key", stacklevel=2)
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key.encode() if key else pii.KEY)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests, by the vocabulary at path."""
    ranks = bpe.load_ranks(path or public_tokenizers.path(RANKS))
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("id") % 20 == 0))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_secret_scans, op3_html_extraction, op4_simhash_near_dedup, op5_url_filters,
    op6_pii, op7_benchmark_decontamination, op8_byte_level_bpe, op9_exact_top_k, op10_chat_formatting,
    op11_vector_codes, op12_conversation_trie, op13_language_id,
)}
