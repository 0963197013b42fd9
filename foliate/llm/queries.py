"""The named queries of this subpackage: thin wrappers that give each operator its whole table.

Six have SQL. A compressor, a trained model, a hash of shingles, a tokenizer or an
HTML parser is part of each of the others; they are tested against brute force, exact
round trips and held-out rows in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import bpe, centroids, chat, decontaminate, html_extract, language_id, line_dedup, prefix_trie, quality, simhash, sql, token_counts, toxicity, url_filters

QUERIES = {}
ORACLES = {
    "op6_line_dedup": sql.LINE_DEDUP,
    "op7_chat_formatting": sql.CHAT_FORMATTING,
    "op10_decontamination": sql.DECONTAMINATION,
    "op11_centroids": sql.CENTROIDS,
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_url_filters": sql.URL_FILTERS,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.limit_table(token_counts.length_histogram(lengths))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=("n_lines", "n_removed"))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.conversation_digests(chat.format_conversations(chat.events_of(turns.unionByName(own))))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify_languages(docs, language_id.train_language_model(docs))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_text(pages, html_extract.train_extractor(pages))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_history(turns))


@query
def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge_urls(pages, url_filters.RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")
