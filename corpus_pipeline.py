"""A training-data pipeline over ``documents``: quality, line dedup, near-duplicates, benchmark, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each as Parquet
in the shared folder and reads it again as the next one's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foliate.llm import bpe, decontaminate, line_dedup, near_dup, quality  # noqa: E402
from foliate.session import ensure_checkpoint_dir  # noqa: E402

#: A compressor, a hash of shingles and a tokenizer take part, which SQL can't express; the stages are tested against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    return quality.keep_good(docs)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted from the texts; a document of which nothing is left goes. ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs, drop_emptied=True)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id: five-word shingles, similarity 0.8 or more.

    SimHash fingerprints within four bits are candidates, MinHash adds those that 64 bits can't tell; whole sets decide.
    """
    return near_dup.keep_one_per_component(docs)


def benchmark_matches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token ids: ``doc_id``, ``n_tokens``, ``ids`` and the decoded text."""
    return bpe.bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_runs),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_matches),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole ``documents`` table."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
